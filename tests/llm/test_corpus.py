"""SimHash, components, mixing, packing, neighbours, token files, pipeline."""

import os
import random
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from helpers import awkward, empty  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from rotorlens.llm import components, mixing, neighbours, packing, simhash, token_files, tokens  # noqa: E402

BPE = public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BPE)
    return [np.array([*x.ids, 0], "<u4") for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_fingerprint_by_the_bit():
    import xxhash
    text = "One two\tthree four\nFIVE É six one two three"
    words = ["one", "two", "three", "four", "five", "É", "six", "one", "two", "three"]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k:k + 3]), 42) for k in range(8)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 8)
    assert simhash.fingerprint(text) % (1 << 64) == want
    assert simhash.fingerprint("A b") % (1 << 64) == xxhash.xxh64_intdigest("a b", 42)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


@pytest.mark.parametrize("leaf, block", [(40, 8000), (40, 30), (5000, 60)])
def test_links_against_brute_force(spark, leaf, block):
    rnd = random.Random(5)
    prints = {0}
    for _ in range(60):
        base = rnd.getrandbits(64)
        prints.add(base)
        for _ in range(rnd.choice([0, 1, 5])):
            for b in rnd.sample(range(64), rnd.choice([1, 2, 3, 4])):
                base ^= 1 << b
            prints.add(base)
    for _ in range(80):  # one dense group
        prints.add(sum(1 << b for b in rnd.sample(range(64), 2)))
    fp = np.array(sorted(prints), np.uint64)
    nodes = spark.createDataFrame([(k, int(x)) for k, x in enumerate(fp.view(np.int64))], "node long, fp long")
    edges = simhash.links(nodes, leaf_size=leaf, block=block)
    got = {r.node: r.component for r in components.connected_components(edges).collect()}
    i, j = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None]) <= 3)
    label = simhash.merge(np.arange(len(fp)), i, j)
    assert {k: got.get(k, k) for k in range(len(fp))} == dict(enumerate(label.tolist()))


def test_near_duplicates_awkward(spark):
    df = awkward(spark)
    got = simhash.near_duplicates(df).collect()
    assert len(got) == df.count()
    assert all(r.component_id == 1 for r in got if r.doc_id in (1, 2, 3)) and all(r.fp == 0 for r in got if r.doc_id in (1, 2, 3))
    assert len({r.component_id for r in got if r.doc_id is not None and r.doc_id >= 50}) <= 2
    kept = simhash.deduped_documents(df)
    assert kept.columns == df.columns and kept.where("doc_id is null").count() == 1
    assert kept.where("doc_id in (1, 2, 3)").count() == 1
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("files", [False, True])
def test_one_row_of_each_group_stays(spark, folder, files):
    text = {c: " ".join(f"{c}{k}" for k in range(30)) for c in "abcd"}
    rows = [(5, text["a"])] * 40 + [(6, text["a"])] * 3 + [(None, text["a"])] * 2 + [(1, text["b"]), (2, text["c"]), (2, text["c"])]
    rows += [(None, text["d"])] * 4
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if files:
        df.repartition(3).write.parquet(f"{folder}/docs")
        df = spark.read.parquet(f"{folder}/docs")
    got = [(r.doc_id, r.text[0]) for r in simhash.deduped_documents(df).collect()]
    assert len(got) == 4 and set(got) == {(5, "a"), (1, "b"), (2, "c"), (None, "d")}


def test_components_of_a_long_path(spark):
    rnd = random.Random(1)
    order = rnd.sample(range(300), 300)
    edges = [(order[k], order[k + 1]) for k in range(199)] + [(order[k], order[200]) for k in range(201, 300)] + [(1, 1), (None, 2)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    first, second = min(order[:200]), min(order[200:])
    assert got == {n: (first if k < 200 else second) for k, n in enumerate(order)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_targets_are_water_filled(spark):
    sizes = {"a": 10, "b": 1000, "c": 20, "d": 0, "e": 500, None: 3}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    names = ["a", "b", "c", "d", "e", None]
    weight, capped = dict(zip(names, (1, 2, 3, 1, 2, 3))), set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[n] for n in capped)
        share = {n: 3 * sizes[n] if n in capped else rest * weight[n] / sum(w for m, w in weight.items() if m not in capped) for n in names}
        above = {n for n in names if n not in capped and share[n] > 3 * sizes[n]}
        if not above:
            break
        capped |= above
    assert got == pytest.approx(share)


def test_flight_keeps_totals_and_is_unbiased():
    rnd = np.random.default_rng(0)
    size, p = rnd.integers(1, 500, 300), np.full(300, 0.37)
    taken = []
    for seed in range(200):
        q = mixing.flight(size, p, np.random.default_rng(seed))
        assert q.sum() == pytest.approx(p.sum()) and (q * size).sum() == pytest.approx((p * size).sum())
        assert ((q > 0) & (q < 1)).sum() <= mixing.LAND
        z = mixing.landing(size, q)
        assert set(np.unique(z)) <= {0.0, 1.0} and abs((z * size).sum() - (p * size).sum()) < 5
        taken.append(q)
    assert abs(np.mean(taken, axis=0) - 0.37).max() < 0.15  # the landing of the last few is by fit, not by lot


def test_mix_in_blocks_comes_near_the_targets(spark):
    rnd = random.Random(2)
    rows = [(k, "w " * rnd.randint(1, 300), "hot" if k % 2 else f"s{k % 7}") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, block=100).toPandas()
    assert len(got) == 3000 and (got.copies <= 3).all()
    taken = (got["copies"] * got["size"]).groupby(got["source"]).sum()
    assert (abs(taken - got.groupby("source").target.first()) <= 5).all()
    again = mixing.mix(df.repartition(3), block=100).toPandas()
    assert got.set_index("doc_id").copies.sort_index().equals(again.set_index("doc_id").copies.sort_index())


def test_mix_awkward(spark):
    df = awkward(spark)
    assert mixing.mix(df).count() == df.count()
    assert mixing.mixed_documents(df).columns == df.columns
    assert mixing.mix(empty(spark)).count() == 0
    zero = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r.target, r.copies) for r in mixing.mix(zero).collect()} == {(0.0, 0)}


@pytest.mark.parametrize("files", [False, True])
def test_mixed_documents_take_null_and_repeated_ids_row_by_row(spark, folder, files):
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, f"w{k} " * 4, "a") for k in range(900)]
    rows += [(10_000 + k, "w " * 100, "b") for k in range(9)] + [(7, "same text here now", "a")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    if files:
        df.repartition(3).write.parquet(f"{folder}/docs")
        df = spark.read.parquet(f"{folder}/docs")
    got = mixing.mixed_documents(df, block=100).toPandas()
    for name, target in {r.source: r.target for r in mixing.mix(df, block=100).select("source", "target").distinct().collect()}.items():
        taken = got[got.source == name].text.str.split().str.len().sum()
        assert abs(taken - target) <= 100 if name == "b" else abs(taken - target) <= 5
    share = len(got[got.source == "a"]) / 1200
    assert 0 < share % 1 and got.doc_id.isnull().sum() > 0
    for part, n in ((got[(got.doc_id == 7)], 600), (got[got.doc_id.isnull()], 300)):
        assert abs(len(part) / n - share) < 0.1
    assert mixing.mixed_documents(df.limit(0)).count() == 0


def test_encoder_equals_the_plain_tokenizer():
    rnd = random.Random(7)
    parts = [" ", " ", "  ", "\n", "\t", "a", "b'", "'ll", "x's.", "1", "²", "é", "\x1c", "!", "<|endoftext|>", "\r", "_", "日本", "🙂", "ab.", "c,,'"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(20_000)] + [None, "z" * 5000 + " y"]
    encoder = tokens.Encoder(tokens.read_tokenizer(BPE))
    for _ in range(2):
        assert [x + bytes(4) for x in encoder.batch(texts)] == [x.tobytes() for x in plain_ids(texts)]


def test_packing_round_trip(spark):
    df = awkward(spark)
    rows = df.select("doc_id", "text").collect()
    pieces = packing.token_pieces(df, BPE, 256, with_ids=True)
    placed = packing.pack(pieces, 256, block=20)
    got = placed.toPandas()
    ids = {r.doc_id: x for r, x in zip(rows, plain_ids([r.text for r in rows]))}
    for r in got.itertuples():
        x = ids[None if np.isnan(r.doc_id) else int(r.doc_id)]
        assert r.ids_crc32 == zlib.crc32(x[r.start:r.start + r.length].tobytes())
        assert r.length == 256 or r.piece == 0
    assert got.length.sum() == sum(len(x) for x in plain_ids([r.text for r in rows]))
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.to_numpy() == np.cumsum([0, *g.length[:-1]])).all() and g.length.sum() <= 256
    assert got.sequence_id.nunique() <= max(-(-got.length.sum() // 256), (got.length > 128).sum()) + 3
    joined = {r.sequence_id: list(r.ids) for r in packing.sequences(placed).collect()}
    assert sum(map(len, joined.values())) == got.length.sum()
    assert packing.pack_documents(empty(spark), BPE).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_once(seed):
    rnd = np.random.default_rng(seed)
    counts = np.bincount(np.clip(rnd.lognormal(3.5, 1, 5000).astype(int), 1, 128), minlength=129)
    used = np.zeros(129, int)
    plan = packing.plan_patterns(counts, 128)
    for lengths, times in plan:
        assert sum(lengths) <= 128 and times > 0
        np.add.at(used, lengths, times)
    assert (used == counts).all()
    least = -(-int(counts @ np.arange(129)) // 128)
    assert sum(times for _, times in plan) <= 1.02 * least + 2


def test_token_files(spark, folder):
    df = awkward(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = sorted(df.select("doc_id", "text").collect())
    token_files.write_tokens(df, f"{folder}/t", BPE, rows_per_file=10)
    held = token_files.read_tokens(spark, f"{folder}/t")
    got = token_files.with_starts(token_files.digests(held), rows_per_range=9).orderBy("doc_id").collect()
    start = 0
    for r, row, x in zip(got, rows, plain_ids([r.text for r in rows])):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (row.doc_id, start, len(x), zlib.crc32(x.tobytes()))
        start += len(x)
    assert len(got) == len(rows)
    order = [r.doc_id for r in held.select("doc_id", F.col("_metadata.file_path").alias("f")).orderBy("f").collect()]
    assert order == sorted(order)
    assert "doc_id" in held.where("doc_id = 5")._jdf.queryExecution().toString()
    token_files.write_tokens(empty(spark), f"{folder}/e", BPE)
    none = token_files.with_starts(token_files.digests(token_files.read_tokens(spark, f"{folder}/e")))
    assert none.count() == 0
    token_files.write_tokens(awkward(spark), f"{folder}/a", BPE)
    assert token_files.with_starts(token_files.digests(token_files.read_tokens(spark, f"{folder}/a"))).count() == awkward(spark).count()


def test_neighbours_recall_against_brute_force(spark):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(12, 16))
    x = (centres[rnd.integers(0, 12, 3000)] + 0.7 * rnd.normal(size=(3000, 16))).astype(np.float32)
    x[500:900] = x[500]  # one common vector
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") % 100 == 0).toPandas()
    hits = 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(3000), d))[:10]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 11))
        assert np.allclose(mine.score, d[mine.vec_id]) and mine.score.is_monotonic_increasing
        hits += len(set(best) & set(mine.vec_id))
    assert hits >= 0.9 * 300
    assert got[got.query_id == 600].sort_values("rank").vec_id.tolist() == list(range(500, 510))


def test_neighbours_awkward(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, None]), (None, [1.0, 1.0]),
            (6, [1.0, 0.0]), (7, [0.0, 2.0]), (7, [0.0, 2.0]), (8, []), (9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "vec_id long, embedding array<double>, node int, d int")
    got = [(r.query_id, r.rank, r.vec_id) for r in neighbours.nearest(df, F.col("id") % 5 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 6), (0, 2, 7)]
    assert neighbours.nearest(df.limit(0), F.col("id") % 5 == 0).count() == 0


def test_pipeline_stages(spark, sf):
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == columns, name
    assert 0 < docs.select("doc_id").distinct().count() <= before
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert placed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert placed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_cluster_without_a_shared_folder_is_refused(spark):
    from rotorlens.llm import common

    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_folder(Cluster())


def test_each_distinct_piece_is_looked_up_once():
    from rotorlens.llm.queries import tokenizer_file
    from rotorlens.llm.tokens import Encoder, read_tokenizer

    class Counted(dict):
        looked = 0

        def get(self, *key):
            self.looked += 1
            return super().get(*key)

    coder = Encoder(read_tokenizer(tokenizer_file()))
    coder._known = Counted()
    long = "q" * 80
    texts = ["the cat sat, " * 500 + "end", f"a {long} b  c {long}", None, "the cat", " x", "wide  \n gap", "one<|endoftext|> two"]
    assert coder.batch(texts) == Encoder(read_tokenizer(tokenizer_file()))._encode([t or "" for t in texts])
    assert coder._known.looked < 50  # once per word of each text before
    assert long not in coder._known and "cat" in coder._known


def test_worker_remembers_pieces_in_bounded_memory():
    """Texts of ever new words: what the encoder keeps of them stays small beside an executor's memory."""
    coder, largest = tokens.Encoder(tokens.read_tokenizer(BPE)), 0
    coder._encode = lambda texts: [b"ids " * 2] * len(texts)
    for k in range(25):
        coder.batch([" ".join(f"{n}x{n}" for n in range(40_000 * k + a, 40_000 * k + a + 8_000)) for a in range(0, 40_000, 8_000)])
        held = [coder._known, coder._older]
        largest = max(largest, sum(sys.getsizeof(d) + sum(map(sys.getsizeof, d)) + sum(map(sys.getsizeof, d.values())) for d in held))
    assert 10_000_000 < largest < 90_000_000


def test_pieces_of_letters_and_punctuation_are_put_together():
    """Heads and tails that are met alone, with each other, again, and beyond the remembered length."""
    coder = tokens.Encoder(tokens.read_tokenizer(BPE))
    long = "Wort" * 40
    texts = ["x wort, wort wort. wort!? été, été ((x)) ..., 3a, a3. " + long + " " + long + ", 日本, 日本", "x wort. " + long + ", été! wort,"]
    for _ in range(2):
        assert coder.batch(texts) == [ids[:-1].tobytes() for ids in plain_ids(texts)]
        coder._older, coder._known = coder._known, {}
    assert long not in coder._older and long + "," not in coder._older
