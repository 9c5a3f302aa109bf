"""Patient features: long tuples, candidate filters, dictionary, vectors, moments.

Long form ``(patient_id string, feature string, value double)`` is canonical.
Every aggregate here is a hash aggregate with map-side partial aggregation.
The only wide step is the per-patient vector, whose width is the dictionary
size (bounded by the code vocabulary, not by the number of events).
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import Iterable, Union

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from medcohort.functions import valuesets as V
from medcohort.functions.sqltext import in_list, quote
from medcohort.session import ensure_checkpoint_dir, state_dir
from medcohort.sources.clinical import ClinicalFrames

Candidates = Union[Iterable[str], DataFrame, None]

FEATURE_SCHEMA = "patient_id string, feature string, value double"


def _restrict(events: DataFrame, col: str, candidates: Candidates, ignore_case: bool) -> DataFrame:
    """Keep events whose ``col`` is in the candidate list.

    A Python list becomes an ``InSet`` predicate (no join). A DataFrame list
    (one column ``item``) is a semi join; the planner picks its strategy from
    the sizes it measures.
    """
    if candidates is None:
        return events
    key = F.lower(F.col(col)) if ignore_case else F.col(col)
    if isinstance(candidates, DataFrame):
        items = candidates.select(F.col(candidates.columns[0]).alias("_item"))
        if ignore_case:
            items = items.select(F.lower("_item").alias("_item"))
        return events.withColumn("_key", key).join(
            items.distinct(), F.col("_key") == F.col("_item"), "left_semi").drop("_key")
    values = list(dict.fromkeys(candidates))
    if ignore_case:
        values = list(dict.fromkeys(v.lower() for v in values))
    return events.filter(key.isin(*values)) if values else events.limit(0)


def _count_features(events: DataFrame, col: str) -> DataFrame:
    return (events.groupBy("patient_id", F.col(col).alias("feature"))
            .agg(F.count(F.lit(1)).cast("double").alias("value")))


def dx_features(dx: DataFrame, candidates: Candidates = None, ignore_case: bool = False) -> DataFrame:
    """A1 / A4: number of diagnoses per (patient, code)."""
    return _count_features(_restrict(dx, "code", candidates, ignore_case), "code")


def med_features(med: DataFrame, candidates: Candidates = None, ignore_case: bool = False) -> DataFrame:
    """A2 / A5: number of orders per (patient, medicine)."""
    return _count_features(_restrict(med, "medicine", candidates, ignore_case), "medicine")


def lab_features(lab: DataFrame, candidates: Candidates = None, ignore_case: bool = False) -> DataFrame:
    """Mean lab value per (patient, test name)."""
    return (_restrict(lab, "test_name", candidates, ignore_case)
            .groupBy("patient_id", F.col("test_name").alias("feature"))
            .agg(F.avg("value").alias("value")))


def _listed(col: str, candidates: Iterable[str], ignore_case: bool) -> str:
    """SQL predicate: ``col`` is on the list."""
    values = [v.lower() if ignore_case else v for v in candidates]
    return in_list(f"lower({col})" if ignore_case else col, values)


def _list_filter(kind: str, col: str, candidates, ignore_case: bool) -> str:
    """SQL predicate for a list filter on one domain (other domains pass)."""
    if candidates is None:
        return "true"
    return f"(kind <> {quote(kind)} OR {_listed(col, candidates, ignore_case)})"


def restrict_tagged(tagged: DataFrame, candidate_dx: Candidates = None, candidate_lab: Candidates = None,
                    candidate_med: Candidates = None, ignore_case: bool = False) -> DataFrame:
    """Apply list filters (F12-F14) to tagged tuples.

    The lists filter on the aggregation key, so filtering the aggregated tuples
    equals aggregating the filtered events.
    """
    lists = {"dx": candidate_dx, "lab": candidate_lab, "med": candidate_med}
    if all(c is None for c in lists.values()):
        return tagged
    if any(isinstance(c, DataFrame) for c in lists.values()):
        return _restrict_tagged_frames(tagged, lists, ignore_case)
    keep = " AND ".join([_list_filter("dx", "feature", candidate_dx, ignore_case),
                         _list_filter("lab", "feature", candidate_lab, ignore_case),
                         _list_filter("med", "feature", candidate_med, ignore_case)])
    return tagged.filter(F.expr(keep))


def _restrict_tagged_frames(tagged: DataFrame, lists: dict, ignore_case: bool) -> DataFrame:
    """List filters where some lists are DataFrames ``(item)``: one semi join on (kind, feature).

    Domains without a list pass through.
    """
    spark = tagged.sparkSession
    parts, open_kinds = [], []
    for kind, items in lists.items():
        if items is None:
            open_kinds.append(kind)
            continue
        if not isinstance(items, DataFrame):
            items = spark.createDataFrame([(v,) for v in dict.fromkeys(items)], "item string")
        col = F.col(items.columns[0])
        parts.append(items.select(F.lit(kind).alias("_kind"),
                                  (F.lower(col) if ignore_case else col).alias("_item")))
    allowed = reduce(DataFrame.unionByName, parts).distinct()
    key = F.lower(F.col("feature")) if ignore_case else F.col("feature")
    listed = tagged.filter(~F.col("kind").isin(*open_kinds)) if open_kinds else tagged
    kept = listed.withColumn("_key", key).join(
        allowed, (F.col("kind") == F.col("_kind")) & (F.col("_key") == F.col("_item")), "left_semi").drop("_key")
    if open_kinds:
        kept = kept.unionByName(tagged.filter(F.col("kind").isin(*open_kinds)))
    return kept


def feature_tuples_tagged(clinical: ClinicalFrames, candidate_dx: Candidates = None,
                          candidate_lab: Candidates = None, candidate_med: Candidates = None,
                          ignore_case: bool = False, by_patient: bool = False) -> DataFrame:
    """``(patient_id, kind, feature, value)``; kind is ``dx``, ``lab`` or ``med``.

    One row per event is tagged with its domain, all domains are unioned and
    aggregated once by (patient, domain, feature): a single shuffle with
    map-side partial aggregation. When the frames carry fused ``lines``,
    diagnoses and labs are read from them in one pass. List filters are
    applied to the events, before the shuffle; with both lists at hand, lines
    on neither go first, which the optimizer moves below the encounter join.
    ``by_patient`` deals the events by patient, so that vectors built from
    the tuples need no other shuffle.
    """
    null_d = F.lit(None).cast("double")
    if clinical.lines is not None:
        lines = clinical.lines
        if not any(c is None or isinstance(c, DataFrame) for c in (candidate_dx, candidate_lab)):
            candidate_dx, candidate_lab = list(candidate_dx), list(candidate_lab)
            lines = lines.filter(F.expr(f"{_listed('code', candidate_dx, ignore_case)} OR "
                                        f"{_listed('test_name', candidate_lab, ignore_case)}"))
        dx_lab = lines.select("patient_id", F.inline(F.array(
            F.struct(F.lit("dx").alias("kind"), F.col("code").alias("feature"), null_d.alias("value")),
            F.struct(F.lit("lab").alias("kind"), F.col("test_name").alias("feature"),
                     F.col("value").alias("value")),
        ))).filter(F.col("feature").isNotNull())
    else:
        dx_lab = clinical.dx.select("patient_id", F.lit("dx").alias("kind"),
                                    F.col("code").alias("feature"), null_d.alias("value")).unionByName(
            clinical.lab.select("patient_id", F.lit("lab").alias("kind"),
                                F.col("test_name").alias("feature"), "value"))
    events = dx_lab.unionByName(clinical.med.select(
        "patient_id", F.lit("med").alias("kind"), F.col("medicine").alias("feature"), null_d.alias("value")))
    if any(isinstance(c, DataFrame) for c in (candidate_dx, candidate_lab, candidate_med)):
        agg_first = True
    else:
        agg_first = False
        events = restrict_tagged(events, candidate_dx, candidate_lab, candidate_med, ignore_case)
    if by_patient:
        events = events.repartition("patient_id")
    agg = events.groupBy("patient_id", "kind", "feature").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.avg("value").alias("mean"))
    out = agg.select("patient_id", "kind", "feature",
                     F.when(F.col("kind") == "lab", F.col("mean")).otherwise(F.col("n")).alias("value"))
    if agg_first:   # lists as DataFrames filter the aggregated tuples (same result: key filter)
        out = restrict_tagged(out, candidate_dx, candidate_lab, candidate_med, ignore_case)
    return out


def feature_tuples(clinical: ClinicalFrames, candidate_dx: Candidates = None,
                   candidate_lab: Candidates = None, candidate_med: Candidates = None,
                   ignore_case: bool = False) -> DataFrame:
    """H2-H4: diagnosis counts, lab means and medication counts (bag union).

    Features are keyed by name only, as in the reference, so one name used in
    two domains for one patient yields two tuples; :func:`assert_unique_features`
    detects that, and :func:`qualified_tuples` keeps them apart. A candidate list
    given as a DataFrame is applied per domain with a semi join.
    """
    lists = (candidate_dx, candidate_lab, candidate_med)
    if any(isinstance(c, DataFrame) for c in lists):
        return reduce(DataFrame.unionByName, [
            dx_features(clinical.dx, candidate_dx, ignore_case),
            lab_features(clinical.lab, candidate_lab, ignore_case),
            med_features(clinical.med, candidate_med, ignore_case),
        ])
    return feature_tuples_tagged(clinical, *lists, ignore_case=ignore_case).drop("kind")


def shipped_candidate_lists() -> dict[str, list[str]]:
    """V8: the shipped lists, lower-cased and de-duplicated like the loader."""
    return {"candidate_dx": V.candidate_diagnoses(),
            "candidate_lab": V.candidate_labs(),
            "candidate_med": V.candidate_medications()}


def filtered_feature_tuples(clinical: ClinicalFrames, ignore_case: bool = False) -> DataFrame:
    """H4: features restricted to the shipped candidate lists."""
    return feature_tuples(clinical, ignore_case=ignore_case, **shipped_candidate_lists())


def duplicate_features(tuples: DataFrame) -> DataFrame:
    """(patient_id, feature) pairs that occur more than once (H2 name clashes)."""
    return (tuples.groupBy("patient_id", "feature").count()
            .filter(F.col("count") > 1).drop("count"))


def assert_unique_features(tuples: DataFrame) -> None:
    """Fail, as a sparse vector with a repeated index would, on a name clash."""
    clash = duplicate_features(tuples).limit(1).collect()
    if clash:
        raise ValueError(f"feature name used twice for one patient: {clash[0].asDict()}")


# ---------------------------------------------------------------------------
# H0: feature dictionary, 0-based ids in binary name order, built distributed
# ---------------------------------------------------------------------------

def feature_names(clinical: ClinicalFrames) -> DataFrame:
    """``(feature)``: the distinct names straight from the events, without the per-patient aggregate."""
    if clinical.lines is not None:
        names = clinical.lines.select(F.explode(F.array("code", "test_name")).alias("feature")).where("feature IS NOT NULL")
    else:
        names = clinical.dx.select(F.col("code").alias("feature")).unionByName(
            clinical.lab.select(F.col("test_name").alias("feature")))
    return names.unionByName(clinical.med.select(F.col("medicine").alias("feature"))).distinct()


def qualified_tuples(tagged: DataFrame) -> DataFrame:
    """H2: tagged tuples with the domain in the feature key (``dx:250.00``), so names of two domains never clash."""
    return tagged.select("patient_id", F.concat_ws(":", "kind", "feature").alias("feature"), "value")


def feature_dictionary(tuples: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """``(feature string, idx int)``: dense 0-based ids in binary name order of the ``feature`` column."""
    return feature_dictionary_distributed(tuples, num_partitions)


def feature_dictionary_distributed(names: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Number the distinct names of any vocabulary, however large.

    Names are range partitioned (balanced by sampling, so no task holds a hot
    share), the partition id is frozen by a checkpoint to the shared checkpoint
    folder, each partition ranks its own names, and a prefix sum over the
    per-partition counts (one row per partition) gives each partition its offset.
    """
    spark = names.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (names.select("feature").distinct().repartitionByRange(n, "feature")
              .select("feature", F.spark_partition_id().alias("part"))
              .checkpoint(eager=True))
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by the partition count, safe to broadcast
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    local = ranged.withColumn(
        "pos", F.row_number().over(Window.partitionBy("part").orderBy("feature")) - 1)
    return (local.join(F.broadcast(offsets), "part")
            .select("feature", (F.col("offset") + F.col("pos")).cast("int").alias("idx")))


# ---------------------------------------------------------------------------
# H1: patient vectors
# ---------------------------------------------------------------------------

def patient_vectors_long(tuples: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``(patient_id, idx, value)``: the COO form of the sparse vectors.

    The planner broadcasts a dictionary that it measures to be small and splits
    a skewed feature of a larger one.
    """
    return tuples.join(dictionary, "feature", "inner").select("patient_id", "idx", "value")


def sparse_entries(vectors_long: DataFrame) -> DataFrame:
    """``(patient_id, indices array<int>, values array<double>)`` sorted by index.

    One group is one patient's distinct features, bounded by the dictionary.
    """
    e = (vectors_long.groupBy("patient_id")
         .agg(F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("e")))
    dup = F.size(F.array_distinct(F.col("e.idx"))) != F.size(F.col("e.idx"))
    indices = F.when(dup, F.raise_error(F.concat(
        F.lit("duplicate feature index for patient "), F.col("patient_id")))).otherwise(F.col("e.idx"))
    return e.select("patient_id", indices.cast("array<int>").alias("indices"), F.col("e.value").alias("values"))


def patient_vectors(vectors_long: DataFrame, size: int) -> DataFrame:
    """``(patient_id, features)``: sparse ML vectors of width ``size``.

    The entries are laid out as the vector type stores them, written to the
    shared folder and read back under that type, so no Python touches a row and
    no vector is filled up. Only patients with at least one tuple appear.
    ``size`` is the dictionary size.
    """
    spark = vectors_long.sparkSession
    layout = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), "indices", "values")
    path = state_dir(spark, f"vectors-{uuid.uuid4().hex}")
    sparse_entries(vectors_long).select("patient_id", layout.alias("features")).write.parquet(path)
    schema = StructType([StructField("patient_id", StringType()), StructField("features", VectorUDT())])
    return spark.read.schema(schema).parquet(path)


def build_vectors(tuples: DataFrame, names: DataFrame | None = None) -> tuple[DataFrame, DataFrame, int]:
    """Dictionary, sparse vectors and width for a tuple frame (H0 + H1).

    ``names`` are its feature names when they can be had without the tuples
    (:func:`feature_names`). The dictionary is written once, so its size is
    known when the join is planned: a small one is broadcast and no tuple is
    shuffled by feature.
    """
    dictionary = feature_dictionary(names if names is not None else tuples)
    path = state_dir(tuples.sparkSession, f"dictionary-{uuid.uuid4().hex}")
    dictionary.write.parquet(path)
    dictionary = tuples.sparkSession.read.schema(dictionary.schema).parquet(path)
    size = dictionary.count()
    return dictionary, patient_vectors(patient_vectors_long(tuples, dictionary), size), size


# ---------------------------------------------------------------------------
# L1 in SQL form: per-feature moments with implicit zeros, z-scores
# ---------------------------------------------------------------------------

def feature_moments(tuples: DataFrame) -> DataFrame:
    """``(feature, n_patients, mean, std)`` over all patients with any feature.

    Absent entries count as 0, as in the matrix that is scaled; ``std`` is the
    sample standard deviation (0 when undefined). With n present values of mean
    m and population variance v among N patients, the sum of squared deviations
    is n * v + n * (N - n) / N * m**2: no difference of large squares.
    """
    n_all = tuples.agg(F.countDistinct("patient_id").cast("double")).scalar()
    j = tuples.groupBy("feature").agg(
        F.count("value").cast("double").alias("n"), F.avg("value").alias("m"),
        F.var_pop("value").alias("v")).withColumn("n_all", n_all)
    n, m, total = F.col("n"), F.col("m"), F.col("n_all")
    squares = n * F.col("v") + n * (total - n) / total * m * m
    return j.select(
        "feature", total.cast("long").alias("n_patients"), (n * m / total).alias("mean"),
        F.when(total > 1, F.sqrt(squares / (total - 1))).otherwise(F.lit(0.0)).alias("std"))


def feature_zscores(tuples: DataFrame, moments: DataFrame | None = None) -> DataFrame:
    """``(patient_id, feature, zscore)`` for the present entries.

    An absent entry's score is ``-mean / std`` from :func:`feature_moments`;
    a zero-variance feature scores 0.
    """
    moments = moments if moments is not None else feature_moments(tuples)
    z = F.when(F.col("std") > 0, (F.col("value") - F.col("mean")) / F.col("std")).otherwise(F.lit(0.0))
    return tuples.join(moments, "feature").select("patient_id", "feature", z.alias("zscore"))
