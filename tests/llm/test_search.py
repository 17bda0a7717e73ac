"""Word spans, lexical search, importance resampling, language model, and workers without the package."""

import hashlib
import math
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from helpers import awkward, empty  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from rotorlens.llm import hashing, importance, language_model, lexical_search, line_dedup, tokens  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, doc_id string, score string, n string"


def items(spark, rows):
    return spark.createDataFrame([(k, t, "x", "x", "x") for k, t in rows], ITEMS)


def test_spans_digests_and_interning():
    import xxhash
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abé中Z") for _ in range(rnd.choice([1, 3, 7, 8, 9, 15, 16, 31, 32, 33, 90]))) for _ in range(400)]
    texts = [" ".join(rnd.choices(words, k=30)) for _ in range(40)] + [None, "", " .. "]
    spans, n = hashing.words_of(texts, hashing.word_table(importance.BREAKS))
    want = [w.encode() for t in texts for w in WORD.findall((t or "").translate(LOWER))]
    assert [spans.bytes_of(k) for k in range(len(spans))] == want and n.tolist()[-3:] == [0, 0, 0]
    assert [int(h) for h in spans.xxh64(5)] == [xxhash.xxh64_intdigest(w, 5) for w in want]
    number, sample = hashing.intern(spans)
    assert len(sample) == len(set(want)) and all(want[sample[k]] == w for k, w in zip(number, want))
    grams, n = hashing.runs_of(*hashing.words_of(["a b  c", "", "d"], hashing.word_table(importance.BREAKS)), 2)
    assert sorted(grams.bytes_of(k) for k in range(len(grams))) == [b"a", b"a b", b"b", b"b c", b"c", b"d"] and n.tolist() == [5, 0, 1]


def test_interning_compares_bytes(monkeypatch):
    spans, _ = hashing.words_of([" ".join(f"w{k % 50}" for k in range(500))], hashing.word_table(importance.BREAKS))
    monkeypatch.setattr(hashing.Spans, "xxh64", lambda self, seed=0: hashing.np.zeros(len(self), hashing.np.uint64))  # all meet
    number, sample = hashing.intern(spans)
    assert len(sample) == 50 and all(spans.bytes_of(sample[number[k]]) == spans.bytes_of(k) for k in range(500))


def searched(docs, queries, best):
    held = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    held = [x for x in held if x[1]]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for key, text in queries:
        found = []
        for doc, c in held:
            m = 75 + (25 * sum(c.values()) * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in TERM.findall((text or "").translate(LOWER)) if c[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(key, k + 1, None if null else doc, -s) for k, (s, null, doc) in enumerate(sorted(found)[:best])]
    return sorted(out, key=str)


@pytest.mark.parametrize("best, block", [(20, 1 << 20), (3, 40)])
def test_search_against_brute_force(spark, best, block):
    many = spark.createDataFrame([(100, "Rare " * 700 + "end", None, None, None), (101, "rare-end RARE", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    df = awkward(spark, extra=False).unionByName(many)
    queries = [(1, "alpha beta Beta zz"), (2, "rare end"), (3, None), (4, " . "), (5, "Été lambda one"), (1, "one two one"), (6, "nothing here")]
    index = lexical_search.sketch_documents(df.withColumns({c: F.lit("x") for c in ("n", "width", "sketch", "item", "rank")}))
    got = lexical_search.search_index(index, items(spark, queries), best, block_bytes=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert rows == searched([(r.doc_id, r.text) for r in df.collect()], queries, best)


def test_search_of_nothing(spark):
    assert lexical_search.search(empty(spark), items(spark, [(1, "a")])).count() == 0
    assert lexical_search.search(awkward(spark), items(spark, [])).count() == 0


def test_bounds_hold_for_every_document(spark):
    df = awkward(spark, extra=False)
    index = lexical_search.sketch_documents(df).toPandas()
    asked = ["alpha", "beta", "x", "one", "zeta"]
    queries = lexical_search.Queries([(1, [t.encode() for t in asked])], 10, {t.encode(): 2 for t in asked})
    for r in index.itertuples():
        c = Counter(TERM.findall(r.text.translate(LOWER)))
        bound = queries.bounds(hashing.np.frombuffer(r.sketch, hashing.np.uint8)[None, :], hashing.np.array([r.n]), hashing.np.array([100]), queries.digests())
        assert bound[0, 0] >= lexical_search.exact_score(Counter({t.encode(): k for t, k in c.items()}), queries.lists[0], 100)


def resampled(docs, target, longest, buckets, least):
    def features(text):
        w = WORD.findall((text or "").translate(LOWER))
        return [zlib.crc32(" ".join(w[k:k + n]).encode()) % buckets for n in range(1, longest + 1) for k in range(len(w) - n + 1)], len(w)
    made = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, f, _ in made for b in f), Counter(b for x in target for b in features(x)[0])
    total, aim = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (aim + buckets)))) for b in range(buckets)]
    rows = []
    for i, f, n in made:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        rows.append((i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    order = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return rows, order[:10 * len(order) // 100]


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_against_brute_force(spark, longest):
    df = awkward(spark)
    target = ["alpha beta gamma", None, "Été one " * 5]
    got = importance.resample(df, items(spark, list(enumerate(target))), longest, 500, 5).collect()
    rows, drawn = resampled([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], target, longest, 500, 5)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in got), key=str) == sorted((r[:4] for r in rows), key=str)
    ranks = sorted((r["rank"], r.doc_id, r.score) for r in got if r["rank"] is not None)
    assert ranks == [(k + 1, r[0], r[3]) for k, r in enumerate(drawn)] and len(ranks) > 2
    assert importance.resampled_documents(df, items(spark, list(enumerate(target))), longest=longest, buckets=500, least_words=5).count() >= len(ranks)


def test_resampling_of_nothing(spark):
    assert importance.resample(empty(spark), items(spark, [(1, "a")])).count() == 0
    got = importance.resample(awkward(spark), items(spark, [])).collect()
    assert len(got) == awkward(spark).count()


def test_language_model_base_and_awkward(spark):
    df = awkward(spark)
    got = language_model.score_documents(df, common=5).collect()
    docs = [(r.doc_id, (r.text or "").encode()) for r in df.select("doc_id", "text").collect()]
    split = lambda b: b.translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split() + [b""]
    out = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    c = Counter(t for i, b in docs if not out(i) for t in split(b))
    total, distinct = sum(c.values()), len(c)
    want = sorted(((i, out(i), len(split(b)), sum(c[t] > 0 for t in split(b)), total) for i, b in docs), key=str)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got), key=str) == want
    base = sorted(sum(math.log10((c[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in split(b)) for _, b in docs)
    assert sorted(r.base_score for r in got) == pytest.approx(base, abs=1e-9)
    assert all(r.score < 0 for r in got)
    assert language_model.score_documents(empty(spark)).count() == 0


def test_language_model_is_a_distribution_that_learns(spark):
    rnd = random.Random(2)
    words = [f"word{k}" for k in range(40)]

    def text():  # every word tells the next one, mostly
        k, out = rnd.randrange(40), []
        for _ in range(120):
            out.append(words[k])
            k = (k + 1) % 40 if rnd.random() < 0.9 else rnd.randrange(40)
        return " ".join(out)

    df = spark.createDataFrame([(k, text()) for k in range(600)], "doc_id long, text string").repartition(3)
    model, encoded = language_model.train(df)
    got = {r.doc_id: r for r in language_model.score_encoded(model, encoded).collect()}
    held = [r for r in got.values() if r.held_out]
    assert held and all(r.score > 0.6 * r.base_score for r in held)
    # The probabilities of all ends of one beginning sum to 1: every word and the end, and all that is spelled.
    starts = [(0, ""), *[(k + 1, w) for k, w in enumerate(words)]]
    single = language_model.encode(spark.createDataFrame(starts, "doc_id long, text string"), model.code, model.tokens, model.distinct)
    units = single.select("doc_id", "units").collect()
    paths = model.code.paths()
    first = {}
    for r in units:
        unit = hashing.np.frombuffer(r.units, hashing.np.int32)
        digests = language_model.contexts(unit, hashing.np.array([0]), paths[-1])
        size, bit, kind, places = language_model.decisions(paths, model.bits_of_table, unit, digests)
        n = int(size[0])
        looked = [model.known.take(p)[:n] for p in places]
        gate = kind[:n].astype(int)
        for v in looked[1:]:
            gate = gate * 4 + (v & 3)
        inputs = [(v >> 2).astype("f4") / language_model.ODDS_UNIT for v in looked] + [hashing.np.full(n, language_model.BIAS, "f4")]
        z = language_model.mixed(model.weights, gate, inputs)
        p = (language_model.squash(z) + model.shares.take(gate * language_model.STEPS + language_model.odds_step(z))) / 2
        first[r.doc_id] = float(hashing.np.prod(hashing.np.where(bit[:n], p, 1 - p)))
    assert 0.9 < sum(first.values()) <= 1.0 + 1e-6
    # A score does not depend on the documents around it.
    alone = language_model.score_units(encoded.where("doc_id = 7"), model).first().score
    assert alone == pytest.approx(got[7].score, rel=1e-6)


def test_added_tokens_get_the_plain_ids():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["a <|endoftext|> b", "x<|endoftext|>", "<|endoftext|><|endoftext|>", "plain words, twice twice.", "", "two  spaces", None,
             "new " * 50 + "word$$$ Été é", "word$$$ new"]
    encoder = tokens.Encoder(tokens.read_tokenizer(path))
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for _ in range(2):  # once new, once remembered
        assert [hashing.np.frombuffer(b, "<u4").tolist() for b in encoder.batch(texts)] == want
    assert 50256 in want[0]


def test_lines_of_one_long_document_go_in_linear_time(spark):
    body = "\n".join(f"this is the shared line number {k:08d} of a long log" for k in range(20_000))
    rows = [(k, body + f"\nown line {k}") for k in range(6)] + [(3, "a line of row three's other text, which nobody shares")]
    got = sorted(tuple(r) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).select(
        "row.doc_id", "n_lines", "n_dropped", F.substring("row.text", 1, 20)).collect())
    assert got[0] == (0, 20_001, 20_000, "own line 0") and got[-1][1:3] == (20_001, 0)
    assert (3, 1, 0, "a line of row three'") in got and (3, 20_001, 20_000, "own line 3") in got


WITHOUT_PACKAGE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
def there(batches):
    import importlib.util
    yield from batches
    assert importlib.util.find_spec("rotorlens") is None
spark.range(2).mapInPandas(there, "id long").collect()
from __spark_entry__ import queries
for name in ("op3_quality_classifier", "op11_lexical_search", "op12_importance_resampling", "op13_language_model"):
    assert queries()[name](spark, {sf!r}).count() > 0
print("all ran")
"""


def test_workers_need_no_package(sf, tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", WITHOUT_PACKAGE.format(repo=repo, sf=sf)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-3000:]
