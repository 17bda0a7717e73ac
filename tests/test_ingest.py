import pytest
from pyspark.sql import functions as F

from rotorlens.functions.numeric import py_float
from rotorlens.sources import spectra as S

PAIR = '{"M":{"frequency":{"N":"10"},"value":{"N":"2"}}}'


def item(readings: str, extra: str = "") -> str:
    return '{"Item":{%s"readings":{"L":[%s]}}}' % (extra, readings)


CASES = {
    "not json": "malformed",
    "": "malformed",
    "null": "malformed",
    "[]": "malformed",
    '{"Item": 5}': "malformed",
    item(PAIR) + " tail": "malformed",
    item(PAIR) + item(PAIR): "malformed",
    item('{"M":{"frequency":"40","value":{"N":"1"}}}'): "malformed",
    item(PAIR) + '],"x":[1': "malformed",
    item(PAIR) + ' ] , "x":[{}': "malformed",
    '{"Item": null}': "malformed",
    '{"Item": {"readings": null}}': "malformed",
    '{"Item": {"readings": {"L": null}}}': "empty_list",
    item(PAIR, '"mode":null,'): "malformed",
    item(PAIR, '"axis":{"N":null},'): "malformed",
    item(PAIR, '"dev_eui":null,'): "malformed",
    item(PAIR, '"dev_eui":{"S":null},'): None,
    item(PAIR, '"note":null,"tags":["a","null"],'): None,
    item(PAIR + ",null"): "malformed",
    item(PAIR + ',{"M":null}'): "malformed",
    item(PAIR + ',{"M":{"frequency":null}}'): None,
    item(PAIR + ',{"M":{"frequency":{"N":null},"value":{"N":"1"}}}'): "malformed",
    item(PAIR + ',{"M":{"frequency":{"N":"1"},"value":null}}'): "malformed",
    '{"Other": {}}': "no_item",
    '{"Item": {"mode": {"N": "1"}}}': "no_readings",
    '{"Item": {"readings": {}}}': "empty_list",
    item(""): "empty_list",
    item('{"S":"x"}'): "no_values",
    item('{"M":{"frequency":{"N":"10"}}}'): "no_values",
    item('{"M":{"frequency":{"N":"10"},"value":{"N":"bad"}}}'): "no_values",
    item(PAIR, '"T1":{"N":"oops"},'): "bad_metadata",
    item(PAIR, '"mode":{"N":"1d"},'): "bad_metadata",
    item(PAIR + ',{"M":{"frequency":{"N":"20"},"value":{"N":"0x10"}}}'): "misaligned",
    item(PAIR + ',{"M":{"frequency":{"N":"x"},"value":{"N":"1"}}}'): None,
    item(PAIR + ',{"S":"x"}'): None,
    item('{"M":{"frequency":{"N":10},"value":{"N":2}}}'): None,
}


@pytest.fixture(scope="module")
def parsed(spark):
    lines = spark.createDataFrame([(line,) for line in CASES], "value string")
    frame = lines.select("value").join(
        S.parse_lines(lines), F.sha2("value", 256) == F.col("record_id"), "left")
    return {r["value"]: r for r in frame.collect()}


@pytest.mark.parametrize("line", list(CASES))
def test_reason_of_each_line(parsed, line):
    assert parsed[line]["discard_reason"] == CASES[line]


def test_defaults_and_metadata(spark):
    full = item(PAIR, '"dev_eui":{"S":"d"},"mode":{"N":"2"},"axis":{"N":"3"},"timestamp":{"N":"17"},"T1":{"N":"21.5"},')
    rows = S.valid_spectra(S.parse_lines(spark.createDataFrame([(item(PAIR),), (full,)], "value string")))
    got = sorted((r["dev_eui"], r["mode"], r["axis"], r["ts_ms"], r["temp"]) for r in rows.collect())
    assert got == [("d", 2.0, 3.0, 17.0, 21.5), ("unknown", -1.0, -1.0, 0.0, 0.0)]


def test_pairwise_parsing_keeps_the_record(spark):
    line = item(PAIR + ',{"M":{"frequency":{"N":"20"},"value":{"N":"bad"}}}')
    lines = spark.createDataFrame([(line,)], "value string")
    row = S.valid_spectra(S.parse_lines(lines, strict=False)).first()
    assert [(p["freq"], p["value"]) for p in row["spectrum"]] == [(10.0, 2.0)]


def test_lenient_scan(spark):
    many = ",".join('{"M":{"frequency":{"N":"%d"}}}' % i for i in range(11))
    few = ",".join([PAIR] * 10)
    bad = ",".join([PAIR] * 10 + ['{"M":{"frequency":{"N":"x"},"value":{"N":"1"}}}'])
    lines = spark.createDataFrame([(item(many),), (item(few),), (item(bad),), ("junk",)], "value string")
    rows = S.parse_lines_lenient(lines).collect()
    assert len(rows) == 1
    assert [p["value"] for p in rows[0]["spectrum"]] == [0.0] * 11


def test_counts_and_files(spark, folder):
    lines = spark.createDataFrame([(line,) for line in CASES], "value string")
    lines.coalesce(1).write.text(f"{folder}/raw")
    counts = {r["outcome"]: r["n"] for r in S.discard_counts(S.parse_lines(S.read_lines(spark, f"{folder}/raw"))).collect()}
    expected = {}
    for reason in CASES.values():
        expected[reason or "valid"] = expected.get(reason or "valid", 0) + 1
    assert counts == expected
    assert S.read_spectra(spark, f"{folder}/raw").count() == expected["valid"]


def test_only_repeated_lines_are_shuffled(spark):
    one, two, three = item(PAIR), item(PAIR + "," + PAIR), item(PAIR, '"note":"x",')
    lines = spark.createDataFrame([(x,) for x in (one, two, two, three, three, three)], "value string")
    rows = S.numbered_lines(lines).collect()
    assert len({r.record_id for r in rows}) == len(rows) == 6
    assert sorted(r.value for r in rows) == sorted([one, two, two, three, three, three])
    assert S.numbered_lines(lines.distinct()).count() == 3
    plain = S.numbered_lines(spark.range(9).selectExpr("cast(id as string) as value"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plain
    some = S.numbered_lines(lines)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in some and "SortMergeJoin" not in some


def test_repeated_lines_are_parsed_once(spark, sf, monkeypatch):
    from rotorlens.plans import catalog
    parses = []
    stored = catalog.materialise

    def seen(df, label="table"):
        parses.append(df._jdf.queryExecution().optimizedPlan().toString().count("from_json"))
        return stored(df, label)

    monkeypatch.setattr(catalog, "materialise", seen)
    out = catalog.repeated_lines(spark, sf)
    assert "from_json" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert len(parses) == 1 and parses[0]
    assert out.agg(F.sum("n") == F.sum("ids")).first()[0]


@pytest.mark.parametrize("text,value", [
    ("1e3", 1000.0), (" 2 ", 2.0), ("+.5", 0.5), ("5.", 5.0), ("-INF", float("-inf")), ("1d", None), ("1f", None),
    ("0x10", None), ("0x1p3", None), (".", None), ("", None), ("Infinity", float("inf")), ("12", 12.0), ("1e5 ", 1e5),
])
def test_number_forms(spark, text, value):
    assert spark.createDataFrame([(text,)], "s string").select(py_float(F.col("s"))).first()[0] == value


def test_nan_text(spark):
    got = spark.createDataFrame([("nAn",)], "s string").select(F.isnan(py_float(F.col("s")))).first()[0]
    assert got is True


def test_filter_does_not_repeat_the_parser(spark):
    lines = spark.createDataFrame([("x",)], "value string")
    plan = S.valid_spectra(S.parse_lines(lines))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
