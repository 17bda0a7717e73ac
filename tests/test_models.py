import hashlib
import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rotorlens.operators import boosting as B
from rotorlens.operators import classify as CL
from rotorlens.operators import clustering as C
from rotorlens.operators import group_iforest as G
from rotorlens.operators import iforest as I
from rotorlens.operators import lof as LOF
from rotorlens.operators import metrics as MT
from rotorlens.operators import scaling as SC
from rotorlens.plans import models as M
from rotorlens.schema import MODEL_INPUTS
from rotorlens.session import shared_dir

RNG = np.random.default_rng(7)


def points(spark, x):
    return spark.createDataFrame([(f"{i:05d}", [float(v) for v in row]) for i, row in enumerate(x)],
                                 "record_id string, x array<double>")


def test_far_points_of_a_cell_do_not_open_it_for_all(spark):
    """A cell that reaches far to the other side is left alone by points far behind the plane between the pivots."""
    rows = [("a", [-1.0], 1, 0, 1.0, 1.0), ("b", [4.0], 1, 0, 4.0, 1.5), ("c", [9.0], 1, 1, 1.0, 1.0)]
    placed = spark.createDataFrame(rows, "vid string, x array<double>, weight long, cell int, reach double, bound double")
    visits = LOF._visits(placed, np.array([[0.0], [10.0]]), np.array([4.0, 90.0]), 20)  # a point at 100 belongs to the second
    assert sorted((r["vid"], r["cell"]) for r in visits.collect()) == [("b", 1)]


def test_neighbours_of_many_cells_with_far_points(spark):
    """Exact, whatever the cells: all distances by hand."""
    x = np.concatenate([RNG.normal(size=(400, 3)), RNG.normal(size=(20, 3)) * 30])
    frame = spark.createDataFrame([(f"{i:05d}", [float(v) for v in r], 1) for i, r in enumerate(x)], "vid string, x array<double>, weight long")
    near = LOF.exact_neighbours(frame, 5, cell_rows=20, block_rows=8).collect()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    for r in near:
        assert np.allclose([n["dist"] for n in r["neighbours"]], np.sort(d[int(r["vid"])])[:5])
    assert len(near) == 420


def stored_bytes(spark):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(shared_dir(spark)) for f in files)


@pytest.mark.parametrize("numbers", [2500])
def test_neighbours_in_many_parts_store_little(spark, numbers):
    """Parts of some cells, and a cell that takes several parts; no copy of a point for each cell it looks into."""
    x = np.concatenate([RNG.normal(size=(900, 10)), RNG.normal(size=(300, 10)) * 0.01, np.full((1, 10), 40.0)]).round(3)
    frame = spark.createDataFrame([(f"{i:05d}", [float(v) for v in r], 1) for i, r in enumerate(x)], "vid string, x array<double>, weight long")
    before = stored_bytes(spark)
    near = LOF.exact_neighbours(frame, 5, cell_rows=20, block_rows=100, numbers=numbers).collect()
    assert stored_bytes(spark) - before < 4 * x.nbytes
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, :5]
    for r in near:
        own = int(r["vid"])
        assert np.allclose([n["dist"] for n in r["neighbours"]], np.sort(d[own])[:5])
        assert own not in [int(n["vid"]) for n in r["neighbours"]]
    assert len(near) == 1201 and sum(len(r["neighbours"]) for r in near) == 5 * 1201
    picked = {int(r["vid"]): [int(n["vid"]) for n in r["neighbours"]] for r in near}
    assert np.mean([picked[i] == order[i].tolist() for i in range(900)]) > 0.99  # ties may be rounded apart


def test_scalers(spark):
    pdf = pd.DataFrame({"a": RNG.normal(3, 2, 500), "b": 4.0})
    df = spark.createDataFrame(pdf)
    standard, robust = SC.standard_scale_fit(df, ["a", "b"]), SC.robust_scale_fit(df, ["a", "b"])
    assert standard.centres == pytest.approx((pdf.a.mean(), 4.0))
    assert standard.scales == pytest.approx((pdf.a.std(ddof=0), 1.0))
    low, mid, high = np.quantile(pdf.a, [0.25, 0.5, 0.75])
    assert robust.centres == pytest.approx((mid, 4.0)) and robust.scales == pytest.approx((high - low, 1.0))
    assert SC.Scaler.from_frame(standard.to_frame(spark)) == standard


def test_forest_finds_outliers_whatever_the_partitioning(spark):
    x = np.concatenate([RNG.normal(size=(2000, 3)), RNG.normal(size=(10, 3)) + 12])
    df = points(spark, x)
    forest = I.isolation_forest_fit(df, 0.05, trees=50)
    again = I.isolation_forest_fit(df.repartition(3), 0.05, trees=50)
    assert forest.threshold == again.threshold
    assert all(np.array_equal(getattr(forest.trees, c), getattr(again.trees, c)) for c in ("feature", "split", "path"))
    out = forest.predict(df).toPandas().sort_values("anomaly_score")
    assert ((out.anomaly_score >= -1) & (out.anomaly_score < 0)).all()
    assert set(out.record_id[:10]) == {f"{i:05d}" for i in range(2000, 2010)}
    assert abs(out.is_anomaly.mean() - 0.05) < 0.01
    stored = I.IsolationForest.from_frame(forest.to_frame(spark))
    assert stored.predict(df).toPandas().set_index("record_id").anomaly_score.equals(
        forest.predict(df).toPandas().set_index("record_id").anomaly_score)


def test_forest_of_few_rows_and_constant_columns(spark):
    df = points(spark, np.ones((5, 2)))
    out = I.isolation_forest_fit(df, 0.2, trees=3).predict(df).toPandas()
    assert out.anomaly_score.nunique() == 1 and not out.is_anomaly.any()


def test_average_path():
    assert list(I.average_path(np.array([1, 2]))) == [0.0, 1.0]
    assert I.average_path(np.array([256]))[0] == pytest.approx(10.2448, abs=1e-3)


def test_group_forests(spark):
    n = 900
    pdf = pd.DataFrame({"record_id": [str(i) for i in range(n)], "g": RNG.choice(["hot", "b", "tiny"], n, p=[.8, .19, .01]),
                        "u": RNG.normal(size=n), "v": RNG.normal(size=n)})
    pdf.loc[:4, ["g", "u", "v"]] = ["hot", 30.0, 30.0]
    df = spark.createDataFrame(pdf)
    models = G.group_forest_fit(df, ["u", "v"], ["g"], contamination=0.02, minimum=50, trees=20)
    assert {r["g"] for r in models.select("g").collect()} == {"hot", "b"}
    out = G.group_forest_predict(df, models, ["u", "v"], ["g"], rows_per_task=100).toPandas()
    assert len(out) == n
    tiny = out[out.g == "tiny"]
    assert tiny.anomaly_score.isna().all() and not tiny.is_anomaly.any()
    assert out[out.u == 30.0].is_anomaly.all()


def test_kmeans_and_centres(spark):
    x = np.concatenate([RNG.normal(c, 0.1, size=(100, 2)) for c in (0, 5, 10, 20)])
    df = points(spark, x)
    model = C.kmeans_fit(df, n_init=4)
    assert model.cost < 20
    labels = C.kmeans_predict(model, df).toPandas()
    centres = [list(map(float, c)) for c in model.centres]
    near = C.nearest_centre(df, centres).toPandas()
    assert dict(zip(labels.record_id, labels.cluster)) == dict(zip(near.record_id, near.cluster))
    assert C.silhouette(C.nearest_centre(df, centres)).first()["verdict"] == "good"


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i, own in enumerate(labels):
        if (labels == own).sum() == 1:
            out.append(0.0)
            continue
        a = d[i, labels == own].sum() / ((labels == own).sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) if c != own)
        out.append((b - a) / max(a, b))
    return np.mean(out)


def test_silhouette(spark):
    x, labels = RNG.normal(size=(150, 3)), RNG.integers(0, 3, 150)
    labels[0] = 9
    df = points(spark, x).join(spark.createDataFrame([(f"{i:05d}", int(c)) for i, c in enumerate(labels)],
                                                     "record_id string, cluster int"), "record_id")
    assert C.silhouette(df).first()["silhouette"] == pytest.approx(brute_silhouette(x, labels), abs=1e-12)
    assert C.silhouette(df, sample=50).first()["rows"] == 50


def test_silhouette_of_all_rows_by_references(spark):
    x = np.concatenate([RNG.normal(c, 1.0, size=(n, 3)) for c, n in ((0, 3000), (2, 1500), (4, 500))])
    labels = np.repeat([0, 1, 2], [3000, 1500, 500])
    rows = [(f"{i:05d}", [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, labels))]
    df = spark.createDataFrame(rows, "record_id string, x array<double>, cluster int").repartition(4)
    got = C.silhouette(df, per_cluster=400).first()
    assert got["rows"] == 5000 and got["silhouette"] == pytest.approx(brute_silhouette(x, labels), abs=0.01)


def test_silhouette_compares_all_rows(spark):
    """Clusters of any size, parts of any size, copies of rows, an offset and a row that is alone."""
    x = np.concatenate([RNG.normal(c, 1.0, size=(n, 3)) for c, n in ((0, 2600), (2, 900), (4, 100))]) + 50
    x[:300] = x[0]
    labels = np.repeat([0, 1, 2], [2600, 900, 100])
    labels[-1] = 7
    rows = [(f"{i % 3000:05d}", [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, labels))]  # ids that repeat
    df = spark.createDataFrame(rows, "record_id string, x array<double>, cluster int").repartition(4)
    got, want = C.silhouette(df).first(), brute_silhouette(x, labels)
    assert got["rows"] == 3600 and got["silhouette"] == pytest.approx(want, abs=1e-10)
    points = C.silhouette_of_all(df, numbers=2000)
    assert points.agg((F.sum(F.col("silhouette") * F.col("n")) / F.sum("n"))).first()[0] == pytest.approx(want, abs=1e-10)
    assert C.silhouette(df.where("cluster = 0")).first()["silhouette"] == 0  # nothing to compare with
    assert C.silhouette(df.where("cluster = 9")).first()["rows"] == 0


def brute_lof(x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    idx = np.argsort(d, axis=1, kind="stable")[:, :k]
    near = np.take_along_axis(d, idx, 1)
    lrd = 1 / (np.maximum(near[:, -1][idx], near).mean(1) + 1e-10)
    return (lrd[idx] / lrd[:, None]).mean(1)


@pytest.mark.parametrize("cell_rows,block_rows", [(4096, 2048), (60, 25)])
def test_lof_with_many_copies(spark, cell_rows, block_rows):
    x = np.concatenate([RNG.normal(size=(250, 3)), RNG.normal(size=(60, 3)) * 0.1 + 5,
                        np.repeat(RNG.normal(size=(1, 3)), 150, axis=0)])
    out = LOF.local_outlier_factor(points(spark, x), 10, cell_rows=cell_rows, block_rows=block_rows).toPandas()
    out = out.sort_values("record_id")
    assert len(out) == len(x)
    assert np.allclose(out.lof, brute_lof(x, 10), rtol=1e-9)


def test_classifier_folds_and_metrics(spark):
    x = np.concatenate([RNG.normal(c, 1.0, size=(60, 2)) for c in (0, 6, 12)])
    df = points(spark, x).withColumn("label", (F.col("record_id").cast("int") / 60).cast("int"))
    model = CL.fault_classifier_fit(df, ["a", "b"], n_estimators=3, depth=2)
    out = model.predict(df).toPandas()
    assert np.allclose([sum(p) for p in out.probability], 1.0)
    assert (out.prediction == out.label).mean() > 0.95
    assert model.importances().sum() == pytest.approx(1.0)
    folds = CL.stratified_folds(df).groupBy("label", "fold").count().toPandas()
    assert (folds["count"] == 12).all() and len(folds) == 15
    scores = CL.cross_validate(df, ["a", "b"], folds=3, n_estimators=2, depth=2)
    summary = MT.cv_summary(scores).first()
    assert summary["mean_accuracy"] > 0.9
    assert summary["std_accuracy"] == pytest.approx(np.std([r["accuracy"] for r in scores.collect()]))


def boosted_by_hand(x, y, classes, rounds, rate, depth):
    """Softmax boosting with trees that try every cut between values; no Spark."""
    raw = np.tile(np.log(np.bincount(y, minlength=classes) / len(y)), (len(y), 1))

    def tree(rows, gap, level):
        best = (1e-12, None)
        for f in range(x.shape[1]) if level < depth else ():
            for cut in np.unique(x[rows, f])[:-1]:
                left = x[rows, f] <= cut
                n, m = left.sum(), (~left).sum()
                gain = n * m / (n + m) * (gap[rows][left].mean() - gap[rows][~left].mean()) ** 2
                if gain > best[0] + 1e-9:
                    best = (gain, (f, cut))
        if best[1] is None:
            g = gap[rows]
            raw_step[rows] = rate * (classes - 1) / classes * g.sum() / (np.abs(g) * (1 - np.abs(g))).sum()
            return
        left = x[rows, best[1][0]] <= best[1][1]
        tree(rows[left], gap, level + 1)
        tree(rows[~left], gap, level + 1)

    for _ in range(rounds):
        p = np.exp(raw - raw.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        steps = []
        for c in range(classes):
            raw_step = np.zeros(len(y))
            tree(np.arange(len(y)), (y == c) - p[:, c], 0)
            steps.append(raw_step)
        raw = raw + np.stack(steps, 1)
    p = np.exp(raw - raw.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def test_boosting_against_softmax_trees_by_hand(spark):
    x = np.round(RNG.normal(size=(60, 3)) * 4)  # few values, so that bins are values
    y = np.clip((x[:, 0] + RNG.normal(size=60) * 3) // 3 + 1, 0, 2).astype(int)
    df = points(spark, x).join(spark.createDataFrame([(f"{i:05d}", int(c)) for i, c in enumerate(y)], "record_id string, label int"), "record_id")
    want = boosted_by_hand(x, y, 3, 4, 0.1, 3)
    for task_rows in (1000, 0):  # all rounds in a task, and a job per level
        models, _ = B.boost(df, [0, 1, 2], "label", "x", 3, 4, 0.1, 3, task_rows=task_rows)
        assert np.allclose(models[0].probabilities(x), want, atol=1e-5)
    got = CL.FaultClassifier(models[0], ("a", "b", "c")).predict(df, only=F.col("label") > 0).toPandas()
    given = got.label > 0
    assert np.allclose(np.array(got.probability[given].tolist()), want[got.record_id[given].astype(int)], atol=1e-5)
    assert got.prediction[~given].isna().all() and got.confidence[~given].isna().all()


def test_levels_take_no_more_tasks_than_cores(spark):
    """Five jobs a round: their number of tasks follows the cores, not the partitions of large shuffles."""
    x = RNG.normal(size=(50, 3))
    df = points(spark, x).withColumn("label", (F.col("x")[0] > 0).cast("int"))
    before, group = spark.conf.get("spark.sql.shuffle.partitions"), "levels"
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.sparkContext.setJobGroup(group, "boosting")
    try:
        B.boost(df, [0, 1], "label", "x", 3, 2, 0.1, 3, task_rows=0)
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(i) for j in tracker.getJobIdsForGroup(group) for i in tracker.getJobInfo(j).stageIds]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(s.numTasks for s in stages if s) <= spark.sparkContext.defaultParallelism


def test_scores_of_a_batch_of_one_row():
    """Raw scores come from a buffer that can't be written; a single row's are contiguous either way."""
    grown = B._Grown.empty(2, 1)
    grown.value[:, 1] = 0.5
    raw = np.frombuffer(np.ones((1, 2)).tobytes()).reshape(1, 2)
    assert B._added(np.zeros((1, 3), np.uint8), raw, [grown], 1).tolist() == [[1.5, 1.5]]
    assert raw.tolist() == [[1.0, 1.0]]


def test_models_grow_in_tasks_of_their_own(spark):
    """Up to ``TASK_ROWS`` rows, all rounds of all models are a few jobs, with a task for every model."""
    x = RNG.normal(size=(400, 3))
    rows = [(f"{i:05d}", [float(v) for v in r], int(r[0] > 0), i % 3) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "record_id string, x array<double>, label int, fold int")
    group = "tasks"
    spark.sparkContext.setJobGroup(group, "boosting")
    try:
        models, judged = B.boost(df, [0, 1], "label", "x", 3, 6, 0.1, 3, "fold", 3)
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(i) for j in tracker.getJobIdsForGroup(group) for i in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(models) == 4 and judged.where("prediction = label").count() > 380
    assert len({s.stageId for s in stages if s}) < 20 and 4 in {s.numTasks for s in stages if s}


def test_a_model_without_rows_in_its_task(spark):
    """One fold holds all rows: the model without it has no trees, and the others are whole."""
    rows = [([float(i)], int(i > 9), 1) for i in range(20)]
    df = spark.createDataFrame(rows, "x array<double>, label int, fold int")
    for task_rows in (100, 0):
        models, judged = B.boost(df, [0, 1], "label", "x", 1, 3, 0.1, 2, "fold", 2, task_rows=task_rows)
        assert [int((m.feature >= 0).any()) for m in models] == [1, 0, 1]
        assert judged.count() == 20


def test_leaves_filled_down_add_the_same(spark):
    """Trees with leaves on several levels give every row the value of its own leaf."""
    feature, cut, value = np.full((1, 8), -1, np.int32), np.zeros((1, 8), np.int32), np.zeros((1, 8))
    feature[0, 1], cut[0, 1], value[0, 2] = 0, 3, 5.0  # node 2 is a leaf, node 3 is parted by the second feature
    feature[0, 3], cut[0, 3], value[0, 6], value[0, 7] = 1, 1, 7.0, 9.0
    bins = np.array([[0, 0], [3, 9], [4, 1], [63, 2]], np.uint8)
    assert B._added(bins, np.ones((4, 1)), [B._Grown(feature, cut, value)], 2).ravel().tolist() == [6.0, 6.0, 8.0, 10.0]


def test_boosted_trees_do_not_depend_on_jobs_or_partitions(spark):
    x = RNG.normal(size=(300, 4))
    rows = [(f"{i:05d}", [float(v) for v in r], int(r[0] > 0) + int(r[1] > 0.5), i % 3) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "record_id string, x array<double>, label int, fold int")
    fits = [B.boost(d, [0, 1, 2], "label", "x", 4, 12, 0.1, 3, "fold", 3, task_rows=n) for d, n in ((df, 1000), (df.repartition(5), 0))]
    for a, b in zip(fits[0][0], fits[1][0]):
        assert all(np.array_equal(getattr(a, c), getattr(b, c)) for c in ("start", "feature", "threshold", "value", "gain"))
    judged = [sorted(map(tuple, f[1].collect())) for f in fits]
    assert judged[0] == judged[1] and len(judged[0]) == 300
    again = B.Ensemble.from_frame(fits[0][0][1].to_frame(spark))
    assert np.array_equal(again.probabilities(x), fits[0][0][1].probabilities(x))


def first_centres_by_hand(x, ids, k, starts, seed):
    """A row at a time, with the digests of the definition."""
    chosen = [[] for _ in range(starts)]
    for step in range(k):
        for s in range(starts):
            best = None
            for i, p in zip(ids, x):
                u = int(hashlib.md5(f"{seed}:{s}:{step}:{i}".encode()).hexdigest()[:13], 16) / 2.0 ** 52
                due = -math.log(1 - u)
                if step:
                    near = min(sum((a - b) ** 2 for a, b in zip(p, c)) for c in chosen[s])
                    due = due / near if near > 0 else math.inf
                if best is None or (due, i) < best[:2]:
                    best = (due, i, list(p))
            chosen[s].append(best[2])
    return np.array(chosen)


def test_first_centres_by_hand(spark):
    x = np.concatenate([RNG.normal(size=(40, 3)), np.ones((5, 3))])
    df = points(spark, x)
    ids = [f"{i:05d}" for i in range(45)]
    assert np.array_equal(C.first_centres(df.repartition(6), 4, 3, 7), first_centres_by_hand(x, ids, 4, 3, 7))
    same = C.first_centres(points(spark, np.ones((5, 2))), 3, 2, 7)
    assert same.shape == (2, 3, 2) and (same == 1).all()
    point = [("a", [float("nan"), 1.0]), ("b", [1.0, 1.0]), ("c", [1.0, 2.0])]
    holes = spark.createDataFrame(point, "record_id string, x array<double>")
    for start in C.first_centres(holes, 2, 8, 7):  # what is no point comes after all others, but for a first centre
        assert np.isnan(start[0]).any() or not np.isnan(start[1]).any()


def test_first_centres_measure_distances_outside_of_expressions(spark):
    """The plan of a step stays small: no fold over the array per start and centre."""
    kind, seen = type(points(spark, np.ones((2, 2)))), []
    before = kind.mapInArrow
    kind.mapInArrow = lambda df, *args, **more: (seen.append(df._jdf.queryExecution().analyzed().toString()), before(df, *args, **more))[1]
    try:
        C.first_centres(points(spark, RNG.normal(size=(9, 2))), 3, 2, 7)
    finally:
        kind.mapInArrow = before
    assert len(seen) == 3 and not any("zip_with" in plan for plan in seen)


def test_kmeans_starts_and_awkward_points(spark):
    x = np.concatenate([RNG.normal(c, 0.1, size=(50, 2)) for c in (0, 9)] + [np.zeros((3, 2))])
    df = points(spark, x)
    one, other = C.kmeans_fit(df, 2, n_init=3), C.kmeans_fit(df.repartition(7), 2, n_init=3)
    assert np.allclose(one.centres, other.centres)
    assert one.cost == pytest.approx(sum(min(((r - np.array(c)) ** 2).sum() for c in one.centres) for r in x))
    same = C.kmeans_fit(points(spark, np.ones((5, 2))), 3, n_init=2)
    assert same.cost == 0 and C.KMeans.from_frame(same.to_frame(spark)) == same


def test_forest_scores_by_walking_each_tree(spark):
    x = np.concatenate([RNG.normal(size=(300, 3)), [[np.nan, 0.0, np.inf]]])
    trees = [I.grow_tree(RNG.normal(size=(64, 3)), f"1:{t}") for t in range(5)]

    def path(tree, row):
        node = 0
        for _ in range(6):
            node = tree["left"][node] if row[tree["feature"][node]] <= tree["split"][node] else tree["right"][node]
        return tree["path"][node]

    want = [-2.0 ** (-np.mean([path(t, row) for t in trees]) / I.average_path(np.array([64]))[0]) for row in x]
    assert np.allclose(I.Trees.pack(trees).score(x, 64), want, rtol=1e-12)


def test_forest_takes_repeated_ids(spark):
    x = RNG.normal(size=(300, 2))
    df = points(spark, x)
    copies = df.unionByName(df.filter("record_id < '00100'")).unionByName(df.filter("record_id = '00007'"))
    forest = I.isolation_forest_fit(copies, 0.1, trees=5)
    assert forest.sub_sample == 256 and forest.score(copies).count() == 401


def test_metrics_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "label int, prediction int")
    report = {r["class"]: r for r in MT.classification_report(df).collect()}
    assert (report["2"]["precision"], report["2"]["recall"], report["2"]["f1"]) == (0, 0, 0)
    assert report["1"]["precision"] == pytest.approx(1 / 3) and report["1"]["recall"] == 1
    both = MT.accuracy_f1_macro(df).first()
    assert both["accuracy"] == 0.5
    assert both["f1_macro"] == pytest.approx((2 / 3 + 0.5 + 0) / 3)
    assert report["macro avg"]["f1"] == pytest.approx(both["f1_macro"])
    assert report["weighted avg"]["recall"] == 0.5


def test_train_save_load_predict(spark, sf, folder):
    from rotorlens.plans import fixtures as fx
    from rotorlens.session import materialise
    features = materialise(fx.features(spark, sf), "test-features")
    training = M.train(features, trees=20, n_init=2, n_estimators=2, folds=2)
    assert {"folds", "cv_summary", "accuracy_f1_macro", "confusion_matrix", "classification_report",
            "top_features", "cluster_distribution"} <= set(training.tables)
    assert training.tables["top_features"].count() == 5
    M.save_models(training.models, folder, spark)
    loaded = M.load_models(spark, folder)
    assert loaded.columns == tuple(MODEL_INPUTS)
    before = M.predict_batch(features, training.models).toPandas().sort_values("record_id").reset_index(drop=True)
    after = M.predict_batch(features, loaded).toPandas().sort_values("record_id").reset_index(drop=True)
    assert before.equals(after)
    normal = before[~before.is_anomaly]
    assert (normal.fault_type == -1).all() and (normal.confidence == 0).all() and all(not p for p in normal.probabilities)
    anomalous = before[before.is_anomaly]
    assert len(anomalous) == 100 and anomalous.fault_type.between(0, 3).all()
    assert np.allclose([sum(p.values()) for p in anomalous.probabilities], 1.0)
    with pytest.raises(ValueError, match="missing columns"):
        M.predict_batch(features.drop("rms"), loaded)


def test_registered_training_takes_the_default_rounds(spark, sf, monkeypatch):
    from rotorlens.operators import classify
    from rotorlens.plans import catalog

    class Seen(Exception):
        pass

    rounds = []

    def boosted(df, classes, label, x, features, n_estimators, *options, **more):
        rounds.append(n_estimators)
        raise Seen

    monkeypatch.setattr(catalog, "_STAGES", {})
    monkeypatch.setattr(classify, "boost", boosted)
    for query in (catalog.fault_classifier, catalog.cv_summary, catalog.supervised_labels):
        with pytest.raises(Seen):
            query(spark, sf)
    assert set(rounds) == {classify.ESTIMATORS} == {100}


def test_digests_are_those_of_the_expressions(spark):
    names = ["7", "é:1", "", None]
    df = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "k int, n string")
    rows = df.select("k", I.unit_digest(F.lit(42), F.lit(3), F.col("n")).alias("u")).orderBy("k").collect()
    assert I.digests("42:3", names).tolist() == [r["u"] for r in rows]


def test_whole_features_without_folds_in_the_plan(spark, sf):
    """Expressions on arrays took most of the time that the training queries spent on features."""
    from rotorlens.functions.spectral import extract_features
    from rotorlens.plans import fixtures as fx
    plan = extract_features(fx.spectra(spark, sf))._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan


def test_digests_are_compared_as_digits(spark):
    df = spark.range(2000).withColumn("d", I.unit_digest(F.lit(42), F.col("id"))).cache()
    some = sorted(r["d"] for r in df.collect())
    for limit in (0.0, some[0], some[700], np.nextafter(some[700], 1), 0.25, 1.0 - 2.0 ** -53, 1.0):
        got = df.filter(I.digest_below(float(limit), F.lit(42), F.col("id"))).count()
        assert got == sum(d < limit for d in some), limit


def test_kmeans_start_in_a_task_equals_jobs_per_iteration(spark):
    """A task per start and a job per iteration find the same centres, which needs a job or two instead of one a step."""
    df = points(spark, RNG.normal(size=(3000, 3)) * [1, 2, 3]).repartition(3)
    tasks, jobs = C.kmeans_fit(df, 4, n_init=3), C.kmeans_fit(df, 4, n_init=3, task_rows=0)
    assert np.allclose(tasks.centres, jobs.centres, rtol=1e-12, atol=1e-12)
    assert math.isclose(tasks.cost, jobs.cost, rel_tol=1e-12)
    rows = df.select("x")
    first = C.first_centres(df, 4, 3, 42)
    spark.sparkContext.setJobGroup("settle", "settle")
    C._settle_in_tasks(rows, first, 300, 1e-9)
    found = spark.sparkContext.statusTracker().getJobIdsForGroup("settle")
    spark.sparkContext.setJobGroup("other", "other")
    assert len(found) <= 3


def test_levels_add_up_smaller_children_and_keep_one_table(spark, monkeypatch):
    """Blocks of rows of several sizes; a level's job adds up one child of a split; old raw scores are deleted."""
    x = RNG.normal(size=(500, 4))
    rows = [([float(v) for v in r], int(r[0] > 0) + int(r[1] * r[2] > 0), i % 3) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "x array<double>, label int, fold int").repartition(3)
    asked, added_up = [], B._added_up
    monkeypatch.setattr(B, "_added_up", lambda state, shape, grown, level, small: asked.append((level, small.sum(), small.size)) or added_up(state, shape, grown, level, small))
    monkeypatch.setattr(B, "BLOCK_ROWS", 64)
    monkeypatch.setattr(B, "GATHERED", 100)
    tables = lambda: {d for d in os.listdir(f"{shared_dir(spark)}/rotorlens") if d.startswith("boosting")}
    before = tables()
    jobs, judged = B.boost(df, [0, 1, 2], "label", "x", 4, 7, 0.1, 3, "fold", 3, task_rows=0)
    assert len(tables() - before) == 1
    assert asked and all(chosen <= every // (2 if level else 1) for level, chosen, every in asked)
    tasks, same = B.boost(df, [0, 1, 2], "label", "x", 4, 7, 0.1, 3, "fold", 3, task_rows=1000)
    for a, b in zip(jobs, tasks):
        assert (a.feature == b.feature).all() and (a.threshold == b.threshold).all() and np.allclose(a.value, b.value, rtol=1e-12)
    count = lambda d: sorted(map(tuple, d.groupBy("fold", "label", "prediction").count().collect()))
    assert count(judged) == count(same)


def test_pairs_of_features_give_the_sums_of_single_ones():
    """Sums by feature and bin of all rows, and of rows in many slots; an odd number of features."""
    n, shape = 70_000, B._Shape(1, 2, 5, 16, 3)
    bins, y = RNG.integers(0, 16, (n, 5)).astype(np.uint8), RNG.integers(0, 2, n)
    rows = B._Rows(shape, bins, y, np.array([-0.3, -1.2]))
    rows.gradient = RNG.integers(-2 ** 20, 2 ** 20, (2, n)).astype(float)
    rows.both = np.full((2, n), float(2 ** 18)) + B.ROW_SHARE  # the largest curvature there is
    few, many = RNG.integers(-1, 3, n), RNG.integers(-1, 300, n)
    for slot in (None, few, many):
        slots = 1 if slot is None else int(slot.max()) + 1
        at, chosen = np.zeros(n, int) if slot is None else slot, slice(None) if slot is None else slot >= 0
        out = np.zeros((3, slots, 5 * 16))
        rows.add(out, 1, slot)
        for f in range(5):
            key = at[chosen] * 16 + bins[chosen, f]
            for part, weight in zip(out, (np.ones(n), rows.gradient[1], np.full(n, 2.0 ** 18))):
                want = np.bincount(key, weight[chosen], slots * 16).reshape(slots, 16)
                assert (part.reshape(slots, 5, 16)[:, f] == want).all()
