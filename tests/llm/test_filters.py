"""Quality rules, URL lists, classifier, line and substring deduplication."""

import datetime
import os
import re
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helpers import awkward, empty  # noqa: E402
from rotorlens.llm import line_dedup, quality_classifier, quality_rules, substring_dedup, url_filters  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeated(text):
    words = WORD.findall(text)
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    return len({j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(k, k + 8)})


def test_repeated_words_against_brute_force(spark):
    texts = ["a b c d e f g h i a b c d e f g h", "x " * 9, "x " * 7, "", "a b c d e f g h " * 3, "one two"]
    df = spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules.document_counts(df).collect()}
    for k, t in enumerate(texts):
        assert got[k].n_repeat_words == repeated(t), t
        assert got[k].n_words == len(WORD.findall(t)) and got[k].word_chars == sum(map(len, WORD.findall(t)))


def test_quality_rules_awkward(spark):
    df = awkward(spark)
    got = quality_rules.quality_rules(df).collect()
    assert len(got) == df.count()
    assert all(r.base_failed and not r.kept for r in got if r.n_words < 20)
    assert quality_rules.quality_rules(empty(spark)).count() == 0


def test_sketch_parts_add_up(spark):
    df = awkward(spark, extra=False)
    counts = quality_rules.document_counts(df)
    key = ["lang", "source", "rate", "bucket"]
    whole = {tuple(r[c] for c in key): r.n for r in quality_rules.sketch(counts).collect()}
    parts = {}
    for part in (counts.where("doc_id % 2 = 0"), counts.where("doc_id % 2 = 1 or doc_id is null")):
        for r in quality_rules.sketch(part).collect():
            parts[tuple(r[c] for c in key)] = parts.get(tuple(r[c] for c in key), 0) + r.n
    assert whole == parts


def test_outliers_are_rejected_and_clean_documents_stay(spark):
    clean = [(k, " ".join(f"word{k * 7 + j}" for j in range(50)) + ".", "en", "s") for k in range(60)]
    junk = [(100 + k, " ".join(f"w{k}{j}***" for j in range(50)), "en", "s") for k in range(5)]
    got = quality_rules.quality_rules(spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string"))
    kept = {r.doc_id for r in got.where("kept").collect()}
    assert kept == set(range(60))


def test_repeats_below_the_base_rule_are_judged_by_their_group(spark):
    fresh = lambda k, n: " ".join(f"word{1000 * k + j}" for j in range(100, 100 + n))
    clean = [(k, fresh(k, 100), "en", "clean") for k in range(60)]
    often = [(100 + k, f"{fresh(k, 80)} {fresh(900, 10)} {fresh(900, 10)}", "en", "often") for k in range(60)]
    odd = [(200, f"{fresh(300, 80)} {fresh(901, 10)} {fresh(901, 10)}", "en", "clean")]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(
        clean + often + odd, "doc_id long, text string, lang string, source string")).collect()}
    assert got[200].n_repeat_words == got[100].n_repeat_words == 20 and not got[200].base_failed
    assert {k for k, r in got.items() if not r.kept} == {200}


def test_url_verdicts_as_of_fetch_time(spark):
    day = lambda n: datetime.date(2024, 1, n)
    entries = spark.createDataFrame([
        ("bad.org", day(5), True), ("bad.org", day(5), False), ("bad.org", day(9), True), ("bad.org", day(20), False),
        ("x.bad.org", day(10), False), ("ok.com/ads", day(2), True), (None, day(1), True), ("n.org", None, True),
        ("n.org", day(1), None)], "key string, since date, blocked boolean")
    cases = [(1, "http://bad.org/", day(4), False), (2, "http://u:p@Bad.ORG:80/x", day(5), True), (3, "https://bad.org.", day(19), True),
             (4, "http://bad.org", day(20), False), (5, "http://x.bad.org/", day(10), False), (6, "http://y.bad.org/", day(10), True),
             (7, "http://ok.com/ads/1?q=/z", day(3), True), (8, "http://ok.com/adsy", day(3), False), (9, None, day(3), False),
             (10, "not a url", day(3), False), (11, "http://bad.org/", None, False), (None, "http://bad.org/", day(6), True),
             (2, "http://u:p@Bad.ORG:80/x", day(5), True)]
    pages = spark.createDataFrame([(a, b, c, "x", 1) for a, b, c, _ in cases], "page_id long, url string, fetched_at date, key string, times int")
    got = sorted(((r.capture_id is not None, r.capture_id or 0), r.blocked) for r in url_filters.url_verdicts(pages, entries).collect())
    assert got == sorted(((a is not None, a or 0), d) for a, _, _, d in cases)
    assert url_filters.url_verdicts(pages.limit(0), entries).count() == 0
    assert not any(r.blocked for r in url_filters.url_verdicts(pages, entries.limit(0)).collect())
    assert {r.page_id for r in url_filters.allowed_captures(pages, entries).collect()} == {1, 4, 5, 8, 9, 10, 11, None}


def test_url_verdicts_on_deep_paths(spark):
    day = lambda n: datetime.date(2024, 1, n)
    entries = spark.createDataFrame([("a.org/1/2/3/4", day(2), True), ("b.org", day(2), True), ("b.org/1/2/3/4/5/6", day(3), False)],
                                    "key string, since date, blocked boolean")
    cases = [(1, "http://a.org/1/2/3/4/5", True), (2, "http://a.org/1/2/3", False), (3, "http://a.org/1/2/3/44", False),
             (4, "http://b.org/1/2/3/4/5/6", False), (5, "http://b.org/1/2/3/4/5", True), (6, "http://a.org//1/2//3/4?x", True)]
    pages = spark.createDataFrame([(k, u, day(9)) for k, u, _ in cases], "page_id long, url string, fetched_at date")
    got = {r.capture_id: r.blocked for r in url_filters.url_verdicts(pages, entries).collect()}
    assert got == {k: b for k, _, b in cases}
    flat = url_filters.url_verdicts(pages, entries.where("key = 'b.org'"))
    assert {r.capture_id for r in flat.where("blocked").collect()} == {4, 5}


def brute_lines(rows):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if doc is None or len(holders.get(key(x), ())) < 5 or max(holders[key(x)]) == doc]
        out.append((doc or -1, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out)


def test_line_dedup_against_brute_force(spark):
    df = awkward(spark)
    got = line_dedup.dedup_lines(df).select("row.doc_id", "n_lines", "n_dropped", "row.text").collect()
    assert sorted((r.doc_id or -1, r.n_lines, r.n_dropped, r.text) for r in got) == brute_lines(
        [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert line_dedup.deduped_documents(df).columns == df.columns
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_classifier_learns_and_takes_awkward_rows(spark):
    rnd = np.random.default_rng(0)
    word = lambda: "".join(rnd.choice(list("abcdefgh"), 5))
    docs = [(k, " ".join(word() + ("***" if k % 4 == 0 else "") for _ in range(40)), "en", "s", 1) for k in range(240)]
    labels = spark.createDataFrame([(k, int(k % 4 != 0)) for k in range(200)] + [(None, 1), (3, None), (4, 0)], "doc_id long, quality int")
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in quality_classifier.classify(df, labels).collect()}
    assert all(got[k].predicted == int(k % 4 != 0) for k in range(240))
    assert all(0 <= r.score <= 1 for r in got.values())
    odd = quality_classifier.classify(awkward(spark), labels)
    assert odd.count() == awkward(spark).count() and odd.where("score is null").count() == 0
    assert quality_classifier.classify(empty(spark), labels).count() == 0
    assert quality_classifier.classify(df, labels.limit(0)).where("score <> 0.5").count() == 0
    assert quality_classifier.accepted_documents(df, labels).columns == df.columns


def test_machine_pairs_in_linear_time():
    rnd = np.random.default_rng(1)
    model = quality_classifier.Machine(0.3, rnd.normal(size=50), rnd.normal(size=(50, 4)))
    index, value = rnd.choice(50, 12, replace=False), rnd.normal(size=12)
    pairs = sum(model.factors[index[i]] @ model.factors[index[j]] * value[i] * value[j] for i in range(12) for j in range(i))
    assert model.margin(index, value) == pytest.approx(0.3 + model.weights[index] @ value + pairs)


def test_training_sample_leaves_the_held_out_fifth(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality_classifier.training_rows(docs, labels)
    assert rows.where("crc32(string(_id)) % 5 = 0").count() == 0
    assert quality_classifier.training_rows(docs, labels, max_rows=7).count() == 7


def test_chunk_ends_follow_the_bytes():
    rnd = np.random.default_rng(2)
    gear = substring_dedup.gear_table()
    body = rnd.integers(97, 123, 5000, dtype=np.uint8)
    shifted = np.concatenate([rnd.integers(97, 123, 37, dtype=np.uint8), body])
    a, b = substring_dedup.chunk_ends(body, gear), substring_dedup.chunk_ends(shifted, gear) - 37
    assert set(a[a > 120]) == set(b[b > 120])
    assert a[-1] == 5000
    long = substring_dedup.chunk_ends(rnd.integers(97, 123, 400_000, dtype=np.uint8), gear)
    assert 35 < np.diff(long).mean() < 45 and (long[2:] - long[:-2]).max() < 258
    h, n = substring_dedup.gear_hashes(body, gear), 1000
    want = sum(int(gear[body[n - k]]) << k for k in range(32)) % (1 << 32)
    assert int(h[n]) == want


def test_passages_against_brute_force(spark):
    rnd = np.random.default_rng(4)
    word = lambda: "".join(rnd.choice(list("abcdefghij"), rnd.integers(2, 9)))
    fresh = lambda n: [word() for _ in range(n)]
    passage, short = fresh(60), fresh(45)
    docs = {k: fresh(30) + (passage if k in (2, 5, 7) else short if k in (1, 3) else []) + fresh(25) for k in range(9)}
    docs[8] = docs[6]
    rows = [(k, " ".join(w)) for k, w in docs.items()] + [(20, None), (21, ""), (None, " ".join(passage)), (2, " ".join(docs[2]))]
    got = {(r.doc_id, r.first_word, r.n_words, r.first_doc_id) for r in substring_dedup.repeated_passages(
        spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, word int")).collect()}
    seen = {}
    for k, w in docs.items():
        for j in range(len(w) - 49):
            seen.setdefault(tuple(w[j:j + 50]), set()).add(k)
    want = set()
    for k, w in docs.items():
        hit = [j for j in range(len(w) - 49) if len(seen[tuple(w[j:j + 50])]) > 1]
        if hit:
            want.add((k, hit[0], hit[-1] - hit[0] + 50, min(min(seen[tuple(w[j:j + 50])]) for j in hit)))
    assert got == want and {k for k, *_ in got} == {2, 5, 7, 6, 8}
    kept = {r.doc_id: r.text for r in substring_dedup.deduped_documents(
        spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.doc_id is not None}
    assert kept[2] == " ".join(docs[2]) and kept[8] == "" and kept[20] is None
    assert set(docs[5]) - set(kept[5].split()) >= set(passage) - set(docs[5][:30]) - set(docs[5][90:])
    assert substring_dedup.repeated_passages(empty(spark)).count() == 0


@pytest.mark.parametrize("letters", [1, 2, 8])
def test_anchors_in_every_passage(letters):
    rnd = np.random.default_rng(letters)
    fresh = lambda n: ["".join(rnd.choice(list("abcdefghijklmnopqrstuvwxyz"), letters)) for _ in range(n)]
    for passage in [fresh(50) for _ in range(300)] + [["x"] * 50, ["x", "y"] * 25]:
        held = []
        for _ in range(2):
            before = fresh(int(rnd.integers(0, 80)))
            tokens = substring_dedup.word_hashes(" ".join(before + passage + fresh(int(rnd.integers(0, 80)))).encode())
            starts = substring_dedup.anchor_starts(tokens)
            held.append({int(k) - len(before) for k in starts if 0 <= k - len(before) <= 50 - substring_dedup.anchor_words(50)})
        assert held[0] & held[1]


def test_rewrapped_and_short_passages_against_the_sql(spark):
    import duckdb
    from rotorlens.llm.oracle import SUBSTRINGS

    rnd = np.random.default_rng(9)
    spaces = [" ", "  ", "\n", "\t", " \r\n", "\x0b", "\x0c "]
    rows = []
    for group in range(40):
        letters = 1 + group % 4
        fresh = lambda n: ["".join(rnd.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), letters)) for _ in range(n)]
        passage = fresh(50 + group % 3)
        for copy in range(2):
            words = fresh(int(rnd.integers(0, 90))) + passage + fresh(int(rnd.integers(0, 90)))
            gaps = rnd.choice(spaces, len(words), p=[0.7] + [0.05] * 6)
            rows.append((2 * group + copy, "".join(w + g for w, g in zip(words, gaps))))
    rows.append((100, "z " * 120)), rows.append((101, "z\n" * 70))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in substring_dedup.repeated_passages(docs).collect()}
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert got == set(con.execute(SUBSTRINGS).fetchall()) and {k for k, *_ in got} == {k for k, _ in rows}
