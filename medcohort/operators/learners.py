"""Scaling and projection (L1-L3) and the mini-batch k-means.

The scaler and, for narrow features, PCA are ``pyspark.ml`` estimators, fed with sparse vectors; wider features use
:mod:`medcohort.operators.components`. K-means and the Gaussian mixture are in :mod:`medcohort.operators.grouping`. The
streaming k-means update (L7) has no ``pyspark.ml`` form, so it is written in DataFrames: nearest centre as a codegen'd
array expression, one hash aggregate for per-cluster counts and sums, then the decayed weighted update on the k-row
centre table. The centres are model parameters (k x dim numbers), the only thing brought to the driver.
"""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medcohort.operators import components as PC
from medcohort.operators.features import feature_moments
from medcohort.session import state_dir

K = 3
SEED = 6250
PCA_COMPONENTS = 10
STREAM_DECAY = 1.0
STREAM_TIME_UNIT = "points"
STREAM_START_WEIGHT = 0.5
#: Up to this many features the covariance (at most 16 MB) is solved on the driver; wider ones are iterated on the cluster.
#: Both give the principal components, to the iteration's tolerance.
DENSE_WIDTH = 2048

# FIXED VALUES: the first 30 normal draws of Spark's own streaming k-means for seed 6250,
# from which it takes the start centres one coordinate after another.
START_DRAWS = (
    0.8954432981375008, 0.8611057671718804, 1.2437701504743883, 1.1473772836781626, -0.6448282977085286,
    1.1909666292118135, -2.0405141129829385, 0.22840483545731904, 0.7511459566301913, -1.0901474955668489,
    -1.0739039639688301, -0.11856841367394759, 0.3731166580959667, 0.939610981330412, 1.2969280516097152,
    0.14776340055934106, -1.1046769986195957, -0.7684516559855848, 0.38052281571259, -0.015128720347862596,
    0.39501761912063943, 0.2897614455379911, -0.6035993957850411, -0.10012686684134221, 0.29146625882746074,
    1.811097211476681, 0.5030325078454325, -2.090470827731552, -0.16867655435618764, -0.5407471551373718,
)

# The dense linear algebra of the PCA eigen-solve on the driver is not safe to
# start from concurrent threads, so fits that use it take turns.
_LINALG_LOCK = threading.Lock()


# ---------------------------------------------------------------------------
# L1-L3: scale and project
# ---------------------------------------------------------------------------

class ScoreTurn(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Takes the mean's scores off projected points and turns every component (``offset``, ``sign``).

    A component's sign is arbitrary and changes with the summation order; scores are turned so that the largest loading
    counts positive. A pipeline stage that can be written and read like any other.
    """

    offset = Param(Params._dummy(), "offset", "scores of the mean", typeConverter=TypeConverters.toListFloat)
    sign = Param(Params._dummy(), "sign", "1 or -1 for each component", typeConverter=TypeConverters.toListFloat)
    column = Param(Params._dummy(), "column", "vector column", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, offset=None, sign=None, column=None):
        super().__init__()
        self._setDefault(column="pca")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        column = self.getOrDefault("column")
        numbers = [F.array(*[F.lit(x) for x in self.getOrDefault(p)]) for p in ("offset", "sign")]
        centred = F.zip_with(vector_to_array(column), numbers[0], lambda a, b: a - b)
        return df.withColumn(column, array_to_vector(F.zip_with(centred, numbers[1], lambda a, b: a * b)))


def fit_projection(vectors: DataFrame, k: int = PCA_COMPONENTS,
                   input_col: str = "features", width: int | None = None) -> PipelineModel:
    """Scale to unit sample std, then PCA to ``k`` components: a pipeline that can be saved and loaded.

    Centring would fill every sparse vector, so the vectors are only divided by
    the std; the covariance subtracts the mean itself, and the mean's own scores
    are taken off the projected points (:class:`ScoreTurn`). ``width`` is the
    vector size when known (saves a job to look at one row).
    """
    width = width or len(vectors.select(input_col).head()[0])
    stages = [
        StandardScaler(withMean=False, withStd=True, inputCol=input_col, outputCol="scaled"),
        PCA(k=min(k, width), inputCol="scaled", outputCol="pca"),
    ]
    with _LINALG_LOCK:
        model = Pipeline(stages=stages).fit(vectors)
    scaler, pca = model.stages
    mean, std = scaler.mean.toArray(), scaler.std.toArray()
    scaled = [m / s if s > 0 else 0.0 for m, s in zip(mean, std)]
    loadings = pca.pc.toArray().T
    sign = [1.0 if row[abs(row).argmax()] >= 0 else -1.0 for row in loadings]
    turn = ScoreTurn(offset=[float(x) for x in loadings @ scaled], sign=sign)
    return PipelineModel([scaler, pca, turn])


def project(model: PipelineModel, vectors: DataFrame) -> DataFrame:
    """L3: scale and project any vector frame with a fitted model (keeps the other columns)."""
    return model.transform(vectors).drop("scaled")


def vector_entries(vectors: DataFrame, input_col: str = "features") -> DataFrame:
    """``(patient_id, idx, value)`` of the stored entries of a vector column.

    The vectors are written to the shared folder and read back under the layout of the vector type, so no row goes
    through Python and none is filled up.
    """
    path = state_dir(vectors.sparkSession, f"entries-{uuid.uuid4().hex}")
    vectors.select("patient_id", F.col(input_col).alias("v")).write.parquet(path)
    layout = "patient_id string, v struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
    rows = vectors.sparkSession.read.schema(layout).parquet(path)
    at = F.when(F.col("v.type") == 0, F.col("v.indices")).otherwise(
        F.sequence(F.lit(0), F.size("v.values") - 1))
    return rows.select("patient_id", F.explode(F.arrays_zip(at.alias("idx"), F.col("v.values").alias("value"))).alias("e")).select(
        "patient_id", F.col("e.idx").alias("idx"), F.col("e.value").alias("value"))


def principal_points(vectors: DataFrame, k: int = PCA_COMPONENTS, width: int | None = None,
                     dense_width: int = DENSE_WIDTH) -> DataFrame:
    """L1, L2: ``(patient_id, x array<double>)``, the scores on the first ``k`` components, for any width."""
    width = width or len(vectors.select("features").head()[0])
    if width <= dense_width:
        return project(fit_projection(vectors, k, width=width), vectors).select(
            "patient_id", vector_to_array("pca").alias("x"))
    entries = PC.stored(vector_entries(vectors), "vector-entries")
    moments = feature_moments(entries.withColumnRenamed("idx", "feature")).withColumnRenamed("feature", "idx")
    return PC.project_long(PC.principal_components(entries, moments, k), entries).withColumnRenamed("pca", "x")


def pca_scores(vectors: DataFrame, k: int = PCA_COMPONENTS) -> DataFrame:
    """``(patient_id, pca array<double>)``."""
    return principal_points(vectors, k).withColumnRenamed("x", "pca")


# ---------------------------------------------------------------------------
# Mini-batch (streaming) k-means
# ---------------------------------------------------------------------------

@dataclass
class Centres:
    """k centres (list of coordinate lists) and their weights."""

    centers: list[list[float]]
    weights: list[float]

    @property
    def k(self) -> int:
        return len(self.centers)

    @property
    def dim(self) -> int:
        return len(self.centers[0])

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, float(w), [float(x) for x in c])
                for i, (c, w) in enumerate(zip(self.centers, self.weights))]
        return spark.createDataFrame(rows, "cluster int, weight double, center array<double>")

    @staticmethod
    def from_frame(df: DataFrame) -> "Centres":
        rows = sorted(df.select("cluster", "weight", "center").collect())   # k rows
        return Centres([list(r.center) for r in rows], [r.weight for r in rows])


def start_centres(k: int, dim: int, weight: float = STREAM_START_WEIGHT) -> Centres:
    """The start centres that Spark's own streaming k-means draws for the study's seed."""
    if k * dim > len(START_DRAWS):
        raise ValueError(f"only {len(START_DRAWS)} start coordinates are pinned; pass your own Centres")
    return Centres([list(START_DRAWS[i * dim:(i + 1) * dim]) for i in range(k)], [float(weight)] * k)


def squared_distance(x: Column, center: list[float]) -> Column:
    c = F.array(*[F.lit(float(v)) for v in center])
    return F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                       lambda acc, v: acc + v)


def nearest_centre(x: Column, centres: Centres) -> Column:
    """Index of the closest centre; ties go to the lowest index."""
    cands = [F.struct(squared_distance(x, c).alias("d"), F.lit(i).alias("i"))
             for i, c in enumerate(centres.centers)]
    return F.array_min(F.array(*cands))["i"]


def _as_array(df: DataFrame, col: str) -> Column:
    dtype = df.schema[col].dataType.simpleString()
    return F.col(col) if dtype.startswith("array") else vector_to_array(F.col(col))


def minibatch_update(points: DataFrame, centres: Centres, features_col: str = "features",
                     decay: float = STREAM_DECAY, time_unit: str = STREAM_TIME_UNIT,
                     split_dying: bool = True) -> DataFrame:
    """One streaming k-means update on a batch: ``(cluster, weight, center)``.

    For a cluster with m new points of sum s, old centre c and weight n:
    n' = n*a + m and c' = c + (m / n') * (s/m - c), where a = decay per batch
    (``time_unit="batches"``) or decay ** (points in the batch) (``"points"``).
    Clusters without points keep their centre, with the discounted weight.
    If the lightest cluster falls below 1e-8 of the heaviest, the heaviest is
    split in two around its centre (``split_dying``).
    """
    if time_unit not in ("batches", "points"):
        raise ValueError("time_unit must be 'batches' or 'points'")
    spark = points.sparkSession
    dim = centres.dim
    x = _as_array(points, features_col)
    assigned = points.select(nearest_centre(x, centres).alias("cluster"), x.alias("x"))
    stats = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("m"),
        F.array(*[F.sum(F.col("x")[j]) for j in range(dim)]).alias("s"))

    every = Window.partitionBy(F.lit(0))   # the k-row centre table only
    old = centres.to_frame(spark)
    j = old.join(F.broadcast(stats), "cluster", "left").select(
        "cluster", "weight", "center",
        F.coalesce(F.col("m"), F.lit(0)).cast("double").alias("m"), "s")
    j = j.withColumn("batch_points", F.sum("m").over(every))
    discount = (F.lit(float(decay)) if time_unit == "batches"
                else F.pow(F.lit(float(decay)), F.col("batch_points")))
    j = j.withColumn("new_w", F.col("weight") * discount + F.col("m"))
    j = j.withColumn("lam", F.col("m") / F.greatest(F.col("new_w"), F.lit(1e-16)))
    j = j.withColumn("step", F.col("lam") / F.col("m"))
    moved = F.zip_with("center", "s",
                       lambda c, s: c * (F.lit(1.0) - F.col("lam")) + s * F.col("step"))
    upd = j.select("cluster", F.col("new_w").alias("weight"),
                   F.when(F.col("m") > 0, moved).otherwise(F.col("center")).alias("center"))
    if not split_dying:
        return upd

    w = upd.select("*",
                   F.max("weight").over(every).alias("max_w"),
                   F.min("weight").over(every).alias("min_w"))
    w = w.select("*",
                 F.min(F.when(F.col("weight") == F.col("max_w"), F.col("cluster"))).over(every).alias("largest"),
                 F.min(F.when(F.col("weight") == F.col("min_w"), F.col("cluster"))).over(every).alias("smallest"))
    w = w.withColumn("big_center", F.first(F.when(F.col("cluster") == F.col("largest"), F.col("center")),
                                           ignorenulls=True).over(every))
    dying = F.col("min_w") < F.lit(1e-8) * F.col("max_w")
    shift = lambda sign: F.transform(
        "big_center", lambda v: v + F.lit(sign) * F.lit(1e-14) * F.greatest(F.abs(v), F.lit(1.0)))
    half = (F.col("max_w") + F.col("min_w")) / 2.0
    is_big, is_small = F.col("cluster") == F.col("largest"), F.col("cluster") == F.col("smallest")
    return w.select(
        "cluster",
        F.when(dying & (is_big | is_small), half).otherwise(F.col("weight")).alias("weight"),
        F.when(dying & is_big, shift(1.0)).when(dying & is_small, shift(-1.0))
        .otherwise(F.col("center")).alias("center"))


def predict_nearest(points: DataFrame, centres: Centres, features_col: str = "pca") -> DataFrame:
    """L8 for the mini-batch model: ``(patient_id, cluster)``."""
    x = _as_array(points, features_col)
    return points.select("patient_id", nearest_centre(x, centres).cast("int").alias("cluster"))


def streaming_kmeans_centres(points: DataFrame, features_col: str = "pca", k: int = K, dim: int | None = None,
                             decay: float = STREAM_DECAY, time_unit: str = STREAM_TIME_UNIT) -> Centres:
    """The pinned start centres after one update with all points."""
    dim = dim or len(points.select(features_col).head()[0])
    return Centres.from_frame(minibatch_update(points, start_centres(k, dim), features_col, decay, time_unit))


def streaming_kmeans_assign(points: DataFrame, features_col: str = "pca", k: int = K,
                            decay: float = STREAM_DECAY, time_unit: str = STREAM_TIME_UNIT,
                            dim: int | None = None) -> DataFrame:
    """One update with all points, then predict."""
    return predict_nearest(points, streaming_kmeans_centres(points, features_col, k, dim, decay, time_unit), features_col)
