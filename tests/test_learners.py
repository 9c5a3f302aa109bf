"""Mini-batch k-means against a brute-force reference; ML learners by properties."""

import numpy as np
import pytest

from medcohort.operators import components as PC
from medcohort.operators import features as FE
from medcohort.operators import grouping as G
from medcohort.operators import learners as C
from medcohort.sources.clinical import load_clinical_view


def brute_update(points, centers, weights, decay, unit):
    """The streaming k-means update rule, written out with numpy."""
    centers = np.array(centers, dtype=float)
    weights = np.array(weights, dtype=float)
    d = ((points[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
    lab = d.argmin(axis=1)                      # first minimum: lowest index on ties
    discount = decay if unit == "batches" else decay ** len(points)
    weights = weights * discount
    for k in range(len(centers)):
        pts = points[lab == k]
        m = len(pts)
        if m == 0:
            continue
        nw = weights[k] + m
        lam = m / max(nw, 1e-16)
        centers[k] = centers[k] * (1 - lam) + pts.sum(axis=0) * (lam / m)
        weights[k] = nw
    big, small = int(weights.argmax()), int(weights.argmin())
    if weights[small] < 1e-8 * weights[big]:
        w = (weights[big] + weights[small]) / 2
        x = centers[big].copy()
        p = 1e-14 * np.maximum(np.abs(x), 1.0)
        centers[big], centers[small] = x + p, x - p
        weights[big] = weights[small] = w
    return centers, weights


@pytest.mark.parametrize("decay,unit", [(1.0, "points"), (0.999, "points"), (0.5, "batches")])
def test_minibatch_matches_brute_force(spark, decay, unit):
    rng = np.random.default_rng(7)
    pts = rng.normal(size=(500, 3)) * [1, 2, 3] + [0, 1, 2]
    df = spark.createDataFrame([(p.tolist(),) for p in pts], "features array<double>")
    start = C.start_centres(3, 3)
    got = C.Centres.from_frame(C.minibatch_update(df, start, "features", decay, unit))
    exp_c, exp_w = brute_update(pts, start.centers, start.weights, decay, unit)
    np.testing.assert_allclose(np.array(got.centers), exp_c, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(np.array(got.weights), exp_w, rtol=1e-12)


def test_dying_cluster_is_split(spark):
    pts = np.array([[1.0, 1.0]] * 10 + [[5.0, 5.0]] * 2)
    df = spark.createDataFrame([(p.tolist(),) for p in pts], "features array<double>")
    start = C.Centres([[1.0, 1.0], [100.0, 100.0], [5.0, 5.0]], [0.5, 1e-12, 0.5])
    got = C.Centres.from_frame(C.minibatch_update(df, start, "features", 1.0, "points"))
    exp_c, exp_w = brute_update(pts, start.centers, start.weights, 1.0, "points")
    np.testing.assert_allclose(np.array(got.weights), exp_w)
    np.testing.assert_allclose(np.array(got.centers), exp_c)
    assert got.weights[1] == got.weights[0]


@pytest.fixture(scope="module")
def vectors(spark):
    c = load_clinical_view(spark, "/root/testdata/sf0.001")
    return FE.build_vectors(FE.feature_tuples(c))[1].persist()


@pytest.fixture(scope="module")
def points(vectors):
    return C.principal_points(vectors).persist()


def assignments(points, name):
    if name == "kmeans":
        return G.assign(points, G.kmeans(points))
    if name == "mixture":
        return G.mixture_assign(points, G.gaussian_mixture(points))
    return C.streaming_kmeans_assign(points, "x")


@pytest.mark.parametrize("name", ["kmeans", "mixture", "streaming"])
def test_learners_cover_every_patient(points, name):
    rows = assignments(points, name).collect()
    assert len(rows) == points.count() == 150
    assert {r.cluster for r in rows} <= {0, 1, 2}
    again = {r.patient_id: r.cluster for r in assignments(points, name).collect()}
    assert again == {r.patient_id: r.cluster for r in rows}


def test_pca_width(points):
    assert len(points.first().x) == 10


def frame(spark, data):
    return spark.createDataFrame([(str(i), [float(v) for v in x]) for i, x in enumerate(data)], "patient_id string, x array<double>")


def blobs(n=240, dim=3, seed=1):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(size=(n // 3, dim)) * 0.4 + 4 * rng.normal(size=dim) for _ in range(3)])


def plain_draw(ids, number):
    import hashlib
    return np.array([(int(hashlib.md5(f"{number}:{i}".encode()).hexdigest()[:G.DRAW_DIGITS], 16) + 0.5) / 16 ** G.DRAW_DIGITS for i in ids])


def plain_start(x, k):
    ids = [str(i) for i in range(len(x))]
    far = lambda c: ((x[:, None, :] - np.array(c)[None, :, :]) ** 2).sum(axis=2)
    found = [x[plain_draw(ids, 0).argmin()]]
    for r in range(1, G.START_ROUNDS + 1):
        d = far(found).min(axis=1)
        with np.errstate(divide="ignore"):
            key = np.where(d > 0, -np.log(plain_draw(ids, r)) / d, np.inf)
        found += [x[i] for i in np.argsort(key, kind="stable")[:G.START_FACTOR * k] if np.isfinite(key[i])]
    weight = np.bincount(far(found).argmin(axis=1), minlength=len(found))
    found, chosen = np.array(found), [int(weight.argmax())]
    while len(chosen) < k:
        away = ((found[:, None, :] - found[chosen][None, :, :]) ** 2).sum(axis=2).min(axis=1) * weight
        if away.max() <= 0:
            break
        chosen.append(int(away.argmax()))
    return found[chosen]


def test_kmeans_equals_plain_steps(spark):
    x = blobs()
    points = frame(spark, x).persist()
    start = G.start_centres(points)
    np.testing.assert_allclose(start, plain_start(x, 3), rtol=1e-12)
    centres = np.array(start)
    for _ in range(5):
        near = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([x[near == i].mean(axis=0) for i in range(3)])
    np.testing.assert_allclose(G.kmeans(points, max_iter=5, tol=0.0), centres, rtol=1e-9)
    assert sorted(np.bincount([r.cluster for r in G.assign(points, centres.tolist()).collect()])) == [80, 80, 80]


@pytest.mark.parametrize("data", [np.zeros((0, 2)), np.ones((1, 2)), np.ones((9, 2)), np.array([[0.0, 0], [1, 1]] * 5)])
def test_learners_with_few_distinct_points(spark, data):
    points = frame(spark, data)
    centres, model = G.kmeans(points), G.gaussian_mixture(points)
    assert len(centres) == min(3, len({tuple(x) for x in data.tolist()}))
    if len(data):
        assert G.assign(points, centres).count() == G.mixture_assign(points, model).count() == len(data)
        assert np.isfinite(model.covariances).all() and abs(model.weights.sum() - 1) < 1e-9
    else:
        assert model is None


def test_mixture_equals_plain_em(spark):
    x = blobs(150, 2, 4) + np.random.default_rng(2).normal(size=(150, 2))
    means = [[-1.0, 0.0], [0.0, 1.0], [2.0, 2.0]]
    got = G.gaussian_mixture(frame(spark, x).persist(), max_iter=6, tol=-1.0, means=means)
    var = x.var(axis=0)
    var = var + G.RIDGE * var.mean()
    ridge = G.RIDGE * var.mean()
    w, m, s = np.full(3, 1 / 3), np.array(means), np.array([np.diag(var)] * 3)
    for _ in range(6):
        d = x[:, None, :] - m
        log = np.log(w) - np.log(2 * np.pi) - 0.5 * np.log(np.linalg.det(s)) - 0.5 * np.einsum("nki,kij,nkj->nk", d, np.linalg.inv(s), d)
        r = np.exp(log - log.max(axis=1, keepdims=True))
        r /= r.sum(axis=1, keepdims=True)
        size = r.sum(axis=0)
        w, m = size / len(x), r.T @ x / size[:, None]
        s = np.array([(r[:, k, None] * x).T @ x / size[k] - np.outer(m[k], m[k]) + ridge * np.eye(2) for k in range(3)])
    np.testing.assert_allclose(got.weights, w, rtol=1e-7)
    np.testing.assert_allclose(got.means, m, rtol=1e-7)
    np.testing.assert_allclose(got.covariances, s, rtol=1e-6)


def low_rank(n=60, width=40, rank=4, seed=5):
    """Sparse counts of few hidden factors: the leading components stand apart."""
    rng = np.random.default_rng(seed)
    x = (rng.random((n, rank)) * [9, 6, 4, 2.5]) @ (rng.random((rank, width)) < 0.3) + rng.random((n, width)) * 0.2
    return np.where(rng.random((n, width)) < 0.9, x, 0.0) + np.eye(n, width)


def test_block_iteration_finds_the_principal_components(spark):
    x = low_rank()
    rows = [(str(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x))]
    entries = spark.createDataFrame(rows, "patient_id string, idx int, value double")
    std = x.std(axis=0, ddof=1)
    moments = spark.createDataFrame([(j, float(x[:, j].mean()), float(std[j])) for j in range(x.shape[1])], "idx int, mean double, std double")
    model = PC.principal_components(entries, moments, 3, rounds=24, tol=1e-12)
    z = (x - x.mean(axis=0)) / std
    value, vector = np.linalg.eigh(z.T @ z / (len(x) - 1))
    np.testing.assert_allclose(model.variances, value[::-1][:3], rtol=1e-5)
    want = vector[:, ::-1][:, :3]
    want = want * np.sign(want[abs(want).argmax(axis=0), range(3)])
    got = np.array([list(r)[3:] for r in sorted(model.loadings.collect())])
    np.testing.assert_allclose(got, want, atol=5e-3)
    points = {r.patient_id: r.pca for r in PC.project_long(model, entries).collect()}
    np.testing.assert_allclose([points[str(i)] for i in range(len(x))], z @ got, atol=1e-9)
    none = spark.createDataFrame([], entries.schema)
    assert PC.principal_components(none, moments.limit(0), 3).k == 0


def test_wide_vectors_take_the_cluster_route(spark):
    from pyspark.ml.linalg import Vectors
    x = low_rank()
    sparse = lambda row: Vectors.sparse(len(row), [(int(j), float(row[j])) for j in np.flatnonzero(row)])
    rows = [(str(i), Vectors.dense(row) if i % 2 else sparse(row)) for i, row in enumerate(x)]
    vectors = spark.createDataFrame(rows, ["patient_id", "features"])
    dense = {r.patient_id: r.x for r in C.principal_points(vectors, 2).collect()}
    wide = {r.patient_id: r.x for r in C.principal_points(vectors, 2, dense_width=1).collect()}
    assert dense.keys() == wide.keys()
    for k, v in dense.items():
        np.testing.assert_allclose(wide[k], v, atol=5e-2)


LOAD = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.ml import PipelineModel
from medcohort.operators import learners as C
from medcohort.session import local_session
spark = local_session(2)
rows = C.project(PipelineModel.load({model!r}), spark.read.parquet({data!r})).select("patient_id", "pca").collect()
print("SCORES", sorted((r.patient_id, [float(x) for x in r.pca]) for r in rows))
spark.stop()
"""


def test_saved_projection_scores_new_patients_in_another_process(spark, vectors, tmp_path):
    import ast
    import os
    import subprocess
    import sys

    fitted = C.fit_projection(vectors.where("patient_id < '5'"))
    new = vectors.where("patient_id >= '5'")
    fitted.write().overwrite().save(str(tmp_path / "model"))
    new.write.parquet(str(tmp_path / "new"))
    code = LOAD.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), model=str(tmp_path / "model"), data=str(tmp_path / "new"))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    line = next(x for x in done.stdout.splitlines() if x.startswith("SCORES"))
    got = ast.literal_eval(line.removeprefix("SCORES "))
    want = sorted((r.patient_id, [float(x) for x in r.pca]) for r in C.project(fitted, new).collect())
    assert len(want) > 10 and [g[0] for g in got] == [w[0] for w in want]
    np.testing.assert_allclose([g[1] for g in got], [w[1] for w in want], rtol=1e-12)


def test_start_centres_are_the_librarys_own(spark):
    own = spark.sparkContext._jvm.org.apache.spark.mllib.clustering.StreamingKMeans()
    for dim in (2, 10):
        own.setK(3).setRandomCenters(dim, 0.5, C.SEED)
        assert [list(c.toArray()) for c in own.latestModel().clusterCenters()] == C.start_centres(3, dim).centers
    with pytest.raises(ValueError):
        C.start_centres(3, 11)


def test_sparse_scores_equal_the_dense_route(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.linalg import Vectors
    c = load_clinical_view(spark, "/root/testdata/sf0.001")
    _, vectors, width = FE.build_vectors(FE.feature_tuples(c))
    got = {r.patient_id: r.pca for r in C.pca_scores(vectors).collect()}
    dense = spark.createDataFrame([(r.patient_id, Vectors.dense(r.features.toArray())) for r in vectors.collect()],
                                  ["patient_id", "features"])
    model = Pipeline(stages=[StandardScaler(withMean=True, withStd=True, inputCol="features", outputCol="scaled"),
                             PCA(k=10, inputCol="scaled", outputCol="pca")]).fit(dense)
    loadings = model.stages[1].pc.toArray()
    sign = np.sign(loadings[abs(loadings).argmax(0), range(10)])
    for r in model.transform(dense).collect():
        np.testing.assert_allclose(got[r.patient_id], r.pca.toArray() * sign, atol=1e-9)


@pytest.mark.parametrize("fit", ["kMeans", "GMM", "StreamingKmeans"])
def test_results_do_not_depend_on_the_layout(spark, fit):
    from medcohort.plans.study import cluster_all
    c = load_clinical_view(spark, "/root/testdata/sf0.001")
    _, vectors, width = FE.build_vectors(FE.feature_tuples(c))
    seen = []
    for n in (2, 4, 13):
        held = []
        got = cluster_all(vectors.repartition(n, "features"), width, 1, held)[fit]
        seen.append(sorted(map(tuple, got.collect())))
        for df in held:
            df.unpersist()
    assert seen[0] == seen[1] == seen[2]


STREAM = """
import sys
sys.path.insert(0, {repo!r})
from medcohort.operators import learners as C
from medcohort.session import local_session
from medcohort.streaming.minibatch import latest_centres, start_streaming_kmeans
spark = local_session(2)
stream = spark.readStream.schema("features array<double>").option("maxFilesPerTrigger", 1).parquet({src!r})
start = C.Centres({centres!r}, [0.5] * 3)
q = start_streaming_kmeans(spark, stream, start, {ckpt!r}, {state!r})
q.awaitTermination()
got = latest_centres(spark, {state!r})
print("CENTRES", got.centers, "WEIGHTS", got.weights)
spark.stop()
"""


def test_stream_goes_on_in_a_new_session(spark, tmp_path):
    """Two drivers, one after the other, end with the centres of the library's own updates."""
    import ast
    import os
    import subprocess
    import sys

    from pyspark.mllib.clustering import StreamingKMeansModel
    rng = np.random.default_rng(11)
    batches = [rng.normal(size=(n, 2)) + off for n, off in ((40, 0.0), (30, 1.0), (20, -2.0))]
    centres = [[0.0, 0.0], [2.0, 2.0], [-2.0, -2.0]]
    src = str(tmp_path / "in")
    code = STREAM.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), src=src, centres=centres,
                         ckpt=str(tmp_path / "ckpt"), state=str(tmp_path / "state"))
    model = StreamingKMeansModel(centres, [0.5] * 3)
    for part in (batches[:1], batches[1:]):
        for b in part:
            spark.createDataFrame([(p.tolist(),) for p in b], "features array<double>") \
                .coalesce(1).write.mode("append").parquet(src)
            model = model.update(spark.sparkContext.parallelize([list(p) for p in b]), 1.0, "points")
        done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
        line = next(x for x in done.stdout.splitlines() if x.startswith("CENTRES"))
        got, weights = map(ast.literal_eval, line.removeprefix("CENTRES ").split(" WEIGHTS "))
        np.testing.assert_allclose(np.array(got), np.array(model.centers), rtol=1e-9)
        np.testing.assert_allclose(np.array(weights), np.array(model.clusterWeights))
    assert len([x for x in os.listdir(tmp_path / "state") if x.startswith("batch_id=")]) == 2


def test_lost_stream_state_fails_the_batch(spark, tmp_path):
    import shutil

    from medcohort.streaming.minibatch import start_streaming_kmeans
    src, state = str(tmp_path / "in"), tmp_path / "state"
    start = C.Centres([[0.0, 0.0], [2.0, 2.0]], [0.5, 0.5])
    for k in range(2):
        spark.createDataFrame([([float(k), 1.0],)], "features array<double>").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("features array<double>").parquet(src)
        query = start_streaming_kmeans(spark, stream, start, str(tmp_path / "ckpt"), str(state))
        if k:
            with pytest.raises(Exception):
                query.awaitTermination()
        else:
            query.awaitTermination()
            shutil.rmtree(state)


def test_parallel_study_equals_sequential(spark):
    from medcohort.plans.study import run_cohort_study
    c = load_clinical_view(spark, "/root/testdata/sf0.001")
    cols = ["feature_set", "algorithm", "n", "purity", "inverse_purity", "report"]
    par = sorted(tuple(r) for r in run_cohort_study(c, parallelism=3).select(*cols).collect())
    seq = sorted(tuple(r) for r in run_cohort_study(c, parallelism=1).select(*cols).collect())
    assert par == seq and len(par) == 6
    assert all(r[2] == 150 for r in par if r[0] == "All")


def test_contingency_agrees_with_report(spark):
    from medcohort.plans.study import cluster_contingency, run_cohort_study
    c = load_clinical_view(spark, "/root/testdata/sf0.001")
    counts = cluster_contingency(c).collect()
    report = {(r.feature_set, r.algorithm): r for r in run_cohort_study(c).collect()}
    for key, row in report.items():
        cells = [r for r in counts if (r.feature_set, r.algorithm) == key]
        assert sum(r.n for r in cells) == row.n
        by_label = {}
        for r in cells:
            by_label[r.label] = max(by_label.get(r.label, 0), r.n)
        assert abs(sum(by_label.values()) / row.n - row.inverse_purity) < 1e-12


def test_evaluate_learners_entry_point(spark):
    from medcohort.operators import phenotype as P
    from medcohort.plans.study import evaluate_learners
    c = load_clinical_view(spark, "/root/testdata/sf0.001")
    _, vectors, width = FE.build_vectors(FE.feature_tuples(c))
    rows = {r.algorithm: r for r in evaluate_learners(P.phenotype_labels(c), vectors, width).collect()}
    assert set(rows) == {"kMeans", "GMM", "StreamingKmeans"}
    assert all(r.n == 150 and 0 < r.purity <= 1 and 0 < r.inverse_purity <= 1 for r in rows.values())


def test_steps_sum_in_tasks_also_over_empty_partitions(spark):
    points = spark.createDataFrame([(str(i), [float(i), 1.0]) for i in range(5)], "patient_id string, x array<double>").repartition(9)
    assert G.summed(points, lambda x, _: x.sum(axis=0)).tolist() == [10.0, 5.0]
    assert G.summed(points.limit(0), lambda x, _: x.sum(axis=0)).tolist() == []
    assert G.lloyd_step(points.limit(0), [[1.0, 2.0]]) == [[1.0, 2.0]]
    assert G.lloyd_step(points, [[0.0, 1.0], [4.0, 1.0], [9.0, 9.0]]) == [[1.0, 1.0], [3.5, 1.0], [9.0, 9.0]]
    some = points.unionByName(spark.createDataFrame([("n", [None, 5.0])], points.schema))
    assert G.lloyd_step(some, [[0.0, 1.0], [4.0, 1.0]]) == [[1.0, 2.0], [3.5, 1.0]]


def test_vectors_of_dealt_tuples_need_no_other_shuffle(spark):
    from medcohort.sources.clinical import load_clinical_view
    tagged = FE.feature_tuples_tagged(load_clinical_view(spark, "/root/testdata/sf0.001"), by_patient=True)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = tagged.groupBy("patient_id").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 3  # two join sides, the events by patient
