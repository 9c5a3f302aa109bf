"""End-to-end cohort study.

load -> phenotype -> features (all, then candidate-filtered) -> vectors ->
scale + PCA -> k-means / Gaussian mixture / streaming k-means -> purity.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medcohort.operators import learners as C
from medcohort.operators import features as FE
from medcohort.operators import grouping as G
from medcohort.operators import metrics as M
from medcohort.operators import phenotype as P
from medcohort.session import ensure_checkpoint_dir
from medcohort.sources.clinical import ClinicalFrames
from medcohort.sources.sinks import report_line


def project_points(vectors: DataFrame, width: int | None = None, held: list | None = None) -> tuple[DataFrame, int]:
    """Scale + PCA the vectors; ``(points (patient_id, x), number of components)``.

    The points are persisted for the iterative learners and appended to ``held``
    for the caller to release; the sparse vectors are already written out.
    """
    width = width or len(vectors.select("features").head()[0])
    dim = min(C.PCA_COMPONENTS, width)
    # small files make fewer partitions than there are cores; the learners' steps are bound by arithmetic
    parts = max(vectors.rdd.getNumPartitions(), vectors.sparkSession.sparkContext.defaultParallelism)
    vectors = vectors.repartition(parts, "patient_id")
    points = C.principal_points(vectors, width=width).persist()   # K2
    if held is not None:
        held.append(points)
    return points, dim


def _in_parallel(tasks: dict, parallelism: int, spark=None) -> dict:
    """Run independent driver-side fits from a thread pool, as Spark ML's tuners do.

    Each fit is a sequence of small jobs; running independent fits together
    keeps the executors busy. Results are the same as sequential fits (no
    learner draws by position).
    """
    if parallelism <= 1:
        return {k: fn() for k, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(parallelism, len(tasks))) as pool:
        wrap = inheritable_thread_target(spark) if spark is not None else inheritable_thread_target
        futures = {k: pool.submit(wrap(fn)) for k, fn in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


def cluster_all(vectors: DataFrame, width: int | None = None,
                parallelism: int = 3, held: list | None = None) -> dict[str, DataFrame]:
    """Scale, project and cluster three ways; ``{algorithm: (patient_id, cluster)}``."""
    points, dim = project_points(vectors, width, held)
    start = G.start_centres(points)   # of k-means and the mixture
    return _in_parallel({
        "kMeans": lambda: G.assign(points, G.kmeans(points, start=start)),
        "GMM": lambda: G.mixture_assign(points, G.gaussian_mixture(points, means=start)),
        "StreamingKmeans": lambda: C.streaming_kmeans_assign(points, "x", dim=dim),
    }, parallelism, points.sparkSession)


def with_labels(assignments: DataFrame, labels: DataFrame) -> DataFrame:
    """Keep the id through prediction, then inner-join the labels."""
    return assignments.join(labels, "patient_id", "inner")


def _stack(assignments: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName,
                  [a.select(F.lit(name).alias("algorithm"), "patient_id", "cluster")
                   for name, a in assignments.items()])


def evaluate_learners(labels: DataFrame, vectors: DataFrame, width: int | None = None) -> DataFrame:
    """``(algorithm, n, purity, inverse_purity)``; the reference printed the latter."""
    with released() as held:
        stacked = with_labels(_stack(cluster_all(vectors, width, held=held)), labels)
        return M.purity_by(stacked, ["algorithm"]).checkpoint(eager=True)


@contextmanager
def released():
    """A list for cached frames; all of them are released at the end, also after a failure."""
    held: list = []
    try:
        yield held
    finally:
        for df in held:
            df.unpersist()


def feature_sets(clinical: ClinicalFrames, candidate_lists: dict | None = None, held: list | None = None) -> dict:
    """``{name: (tuples, vectors, width)}`` for all features and for those on the candidate lists.

    The tagged tuples are aggregated once and cached; the filtered set is a
    filter on them (the lists filter on the aggregation key).
    """
    tagged = FE.feature_tuples_tagged(clinical, by_patient=True).persist()   # K1
    if held is not None:
        held.append(tagged)
    filtered = FE.restrict_tagged(tagged, **(candidate_lists or FE.shipped_candidate_lists()))
    tuples = {"All": tagged.drop("kind"), "Filtered": filtered.drop("kind")}
    built = _in_parallel({name: (lambda t=t: FE.build_vectors(t)) for name, t in tuples.items()}, 2, clinical.med.sparkSession)
    return {name: (tuples[name], *built[name][1:]) for name in tuples}


def labelled_assignments(clinical: ClinicalFrames, held: list, parallelism: int = 3,
                         candidate_lists: dict | None = None) -> DataFrame:
    """``(feature_set, algorithm, patient_id, cluster, label)`` for all six assignments.

    ``candidate_lists`` maps ``candidate_dx`` / ``candidate_lab`` /
    ``candidate_med`` to lists or one-column DataFrames (e.g. from
    ``load_code_lists``); default: the shipped lists. Frames cached here are
    appended to ``held``.
    """
    ensure_checkpoint_dir(clinical.med.sparkSession)
    sets = feature_sets(clinical, candidate_lists, held)
    labels = P.phenotype_labels(clinical)

    def one_set(name):
        _, vectors, width = sets[name]
        assigned = _stack(cluster_all(vectors, width, parallelism, held))
        return assigned.select(F.lit(name).alias("feature_set"), "*")

    done = _in_parallel({name: (lambda n=name: one_set(n)) for name in sets}, parallelism,
                        clinical.med.sparkSession)
    return with_labels(reduce(DataFrame.unionByName, [done[name] for name in sets]), labels)


def run_cohort_study(clinical: ClinicalFrames, parallelism: int = 3,
                     candidate_lists: dict | None = None) -> DataFrame:
    """``(feature_set, algorithm, n, purity, inverse_purity, report)``.

    All six assignments are scored against the labels in one job.
    """
    with released() as held:
        stacked = labelled_assignments(clinical, held, parallelism, candidate_lists)
        scored = M.purity_by(stacked, ["feature_set", "algorithm"])
        return scored.withColumn("report", report_line()).checkpoint(eager=True)


def cluster_contingency(clinical: ClinicalFrames, parallelism: int = 3,
                           candidate_lists: dict | None = None) -> DataFrame:
    """A9 for the study: ``(feature_set, algorithm, label, cluster, n)`` pair counts."""
    with released() as held:
        stacked = labelled_assignments(clinical, held, parallelism, candidate_lists)
        return stacked.groupBy("feature_set", "algorithm", "label", "cluster").agg(
            F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
