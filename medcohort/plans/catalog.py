"""Registered queries over the driver tables and their DuckDB oracle texts.

Every query reads the given parquet tables (through the clinical view over
``orders`` / ``lineitem``, or ``events`` / ``customer`` / ``lineitem``
directly) and runs over them whole. Computed doubles that are sums of many
terms are rounded to 6 decimals on both sides so summation order cannot
change the compared value.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medcohort.functions import parsing as PA
from medcohort.functions import valuesets as V
from medcohort.operators import components as PC
from medcohort.operators import features as FE
from medcohort.operators import grouping as G
from medcohort.operators import learners as C
from medcohort.operators import metrics as M
from medcohort.operators import phenotype as P
from medcohort.plans import study as S
from medcohort.session import ensure_checkpoint_dir, state_dir
from medcohort.sources import csv_tables as CT
from medcohort.sources import event_tables as ET
from medcohort.sources.clinical import clinical_view_sql, load_clinical_view, read_table, stored_patients
from medcohort.sources.sinks import report_line, write_feature_tuples_tsv, write_labels_tsv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ROUND = 6


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _r(col: str):
    return F.round(F.col(col), ROUND).alias(col)


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in dict.fromkeys(values))


# ---------------------------------------------------------------------------
# Shared SQL (DuckDB): the clinical view, then the rule in set-algebra form
# ---------------------------------------------------------------------------

_ABNORMAL_SQL = " OR ".join(
    f"(lower(test_name) = '{t}' AND value {op} {th})" for t, op, th in V.ABNORMAL_LAB_RULES)

SETS_SQL = f"""WITH {clinical_view_sql()},
patients AS (SELECT patient_id FROM dx UNION SELECT patient_id FROM lab UNION SELECT patient_id FROM med),
t1_dx AS (SELECT DISTINCT patient_id FROM dx WHERE code IN ({_sql_list(V.T1DM_DX)})),
t2_dx AS (SELECT DISTINCT patient_id FROM dx WHERE code IN ({_sql_list(V.T2DM_DX)})),
t1_med AS (SELECT DISTINCT patient_id FROM med WHERE lower(medicine) IN ({_sql_list(V.T1DM_MED)})),
t2_med AS (SELECT DISTINCT patient_id FROM med WHERE lower(medicine) IN ({_sql_list(V.T2DM_MED)})),
related AS (SELECT DISTINCT patient_id FROM dx
            WHERE code IN ({_sql_list(V.DM_RELATED_DX)}) OR code LIKE '{V.DM_RELATED_PREFIX}%'),
no_t1_dx AS (SELECT patient_id FROM patients EXCEPT SELECT patient_id FROM t1_dx),
base AS (SELECT patient_id FROM t2_dx EXCEPT SELECT patient_id FROM t1_dx),
path1 AS (SELECT patient_id FROM base EXCEPT SELECT patient_id FROM t1_med),
path2 AS ((SELECT patient_id FROM base INTERSECT SELECT patient_id FROM t1_med)
          EXCEPT SELECT patient_id FROM t2_med),
t1_first AS (SELECT patient_id, min(date) AS d FROM med
             WHERE lower(medicine) IN ({_sql_list(V.T1DM_MED)}) GROUP BY patient_id),
t2_first AS (SELECT patient_id, min(date) AS d FROM med
             WHERE lower(medicine) IN ({_sql_list(V.T2DM_MED)}) GROUP BY patient_id),
path3 AS (SELECT b.patient_id FROM base b JOIN t1_first a ON a.patient_id = b.patient_id
          JOIN t2_first c ON c.patient_id = b.patient_id WHERE a.d > c.d),
cases AS (SELECT patient_id FROM path1 UNION SELECT patient_id FROM path2 UNION SELECT patient_id FROM path3),
glucose AS (SELECT DISTINCT patient_id FROM lab WHERE lower(test_name) LIKE '%{V.GLUCOSE_TESTED_SUBSTRING}%'),
abnormal AS (SELECT DISTINCT patient_id FROM lab
             WHERE patient_id IN (SELECT patient_id FROM glucose) AND ({_ABNORMAL_SQL})),
controls AS ((SELECT patient_id FROM glucose EXCEPT SELECT patient_id FROM abnormal)
             INTERSECT (SELECT patient_id FROM patients EXCEPT SELECT patient_id FROM related)),
others AS (SELECT patient_id FROM patients EXCEPT SELECT patient_id FROM cases
           EXCEPT SELECT patient_id FROM controls),
labels AS (SELECT patient_id, 1 AS label FROM cases UNION ALL SELECT patient_id, 2 AS label FROM controls
           UNION ALL SELECT patient_id, 3 AS label FROM others)"""


def _feature_sql(filtered: bool) -> str:
    dxf = f"WHERE code IN ({_sql_list(V.candidate_diagnoses())})" if filtered else ""
    labf = f"WHERE test_name IN ({_sql_list(V.candidate_labs())})" if filtered else ""
    medf = f"WHERE medicine IN ({_sql_list(V.candidate_medications())})" if filtered else ""
    return f"""
dxf AS (SELECT patient_id, code AS feature, CAST(count(*) AS DOUBLE) AS value FROM dx {dxf} GROUP BY 1, 2),
labf AS (SELECT patient_id, test_name AS feature, avg(value) AS value FROM lab {labf} GROUP BY 1, 2),
medf AS (SELECT patient_id, medicine AS feature, CAST(count(*) AS DOUBLE) AS value FROM med {medf} GROUP BY 1, 2),
tuples AS (SELECT * FROM dxf UNION ALL SELECT * FROM labf UNION ALL SELECT * FROM medf)"""


FEATURES_SQL = f"WITH {clinical_view_sql()}, {_feature_sql(False)}"
FILTERED_FEATURES_SQL = f"WITH {clinical_view_sql()}, {_feature_sql(True)}"
DICT_SQL = """,
dict AS (SELECT feature, CAST(row_number() OVER (ORDER BY feature) - 1 AS INTEGER) AS idx
         FROM (SELECT DISTINCT feature FROM tuples) d)"""


# ---------------------------------------------------------------------------
# Event frames
# ---------------------------------------------------------------------------

def clin(spark: SparkSession, sf_dir: str):
    return load_clinical_view(spark, sf_dir)


@register("dx_events", f"WITH {clinical_view_sql()} SELECT patient_id, code, date FROM dx")
def q_dx_events(spark, sf_dir):
    return clin(spark, sf_dir).dx


@register("med_events", f"WITH {clinical_view_sql()} SELECT patient_id, date, medicine FROM med")
def q_med_events(spark, sf_dir):
    return clin(spark, sf_dir).med


@register("lab_events",
          f"WITH {clinical_view_sql()} SELECT patient_id, date, test_name, round(value, {ROUND}) AS value FROM lab")
def q_lab_events(spark, sf_dir):
    return clin(spark, sf_dir).lab.select("patient_id", "date", "test_name", _r("value"))


# ---------------------------------------------------------------------------
# Phenotype sets and labels
# ---------------------------------------------------------------------------

@register("patients", f"{SETS_SQL} SELECT patient_id FROM patients")
def q_patients(spark, sf_dir):
    return P.all_patients(clin(spark, sf_dir))


def _flag_query(cond):
    def q(spark, sf_dir):
        flags = P.patient_flags(clin(spark, sf_dir))
        return P.patients_where(flags, cond())
    return q


_FLAG_QUERIES = {
    "no_t1_dx_patients": ("no_t1_dx", lambda: F.col("t1_dx") == 0),
    "case_path_1": ("path1", P.case_path_1),
    "case_path_2": ("path2", P.case_path_2),
    "case_path_3": ("path3", P.case_path_3),
    "case_patients": ("cases", P.is_case),
    "control_patients": ("controls", lambda: P.label_column() == P.CONTROL),
    "other_patients": ("others", lambda: P.label_column() == P.OTHER),
}
for _name, (_cte, _cond) in _FLAG_QUERIES.items():
    register(_name, f"{SETS_SQL} SELECT patient_id FROM {_cte}")(_flag_query(_cond))


def _event_query(frame: str, cond):
    def q(spark, sf_dir):
        return P.event_patients(getattr(clin(spark, sf_dir), frame), cond())
    return q


# a predicate on one event frame: medications touch orders alone, the others skip them
_EVENT_QUERIES = {
    "t1_dx_patients": ("t1_dx", "dx", P.is_t1_dx),
    "t2_dx_patients": ("t2_dx", "dx", P.is_t2_dx),
    "related_dx_patients": ("related", "dx", P.is_related_dx),
    "t1_med_patients": ("t1_med", "med", P.is_t1_med),
    "t2_med_patients": ("t2_med", "med", P.is_t2_med),
    "glucose_tested": ("glucose", "lab", P.is_glucose_tested),
}
for _name, (_cte, _frame, _cond) in _EVENT_QUERIES.items():
    register(_name, f"{SETS_SQL} SELECT patient_id FROM {_cte}")(_event_query(_frame, _cond))


def _both(frame: DataFrame, first, second) -> DataFrame:
    """Patients by two predicates on one frame, in one aggregate: has the first, and (not) the second."""
    return frame.groupBy("patient_id").agg(F.max(first.cast("int")).alias("first"), F.max(second.cast("int")).alias("second"))


@register("t2_without_t1_dx", f"{SETS_SQL} SELECT patient_id FROM base")
def q_t2_without_t1_dx(spark, sf_dir):
    dx = clin(spark, sf_dir).dx.filter(P.is_t2_dx() | P.is_t1_dx())
    return _both(dx, P.is_t2_dx(), P.is_t1_dx()).where("first = 1 AND second = 0").select("patient_id")


@register("abnormal_lab_patients", f"{SETS_SQL} SELECT patient_id FROM abnormal")
def q_abnormal_lab_patients(spark, sf_dir):
    lab = clin(spark, sf_dir).lab.filter(P.is_glucose_tested() | P.is_abnormal_lab())
    return _both(lab, P.is_glucose_tested(), P.is_abnormal_lab()).where("first = 1 AND second = 1").select("patient_id")


@register("phenotype_labels", f"{SETS_SQL} SELECT patient_id, label FROM labels")
def q_phenotype_labels(spark, sf_dir):
    return P.phenotype_labels(clin(spark, sf_dir))


@register("phenotype_labels_setwise", f"{SETS_SQL} SELECT patient_id, label FROM labels")
def q_phenotype_labels_setwise(spark, sf_dir):
    """The labels by set operations (J2, J8, J9, U3, U4, F9) on stored membership rows: one read of the event join."""
    ensure_checkpoint_dir(spark)
    s = P.member_sets(P.patient_flags(clin(spark, sf_dir)))
    on = "patient_id"
    untreated = s["t1_med"].join(s["t2_med"], on, "left_anti")
    treated_late = s["t2_med_before_t1"].intersect(s["t2_med"])
    allowed = s["patients"].exceptAll(s["t1_med"]).unionByName(untreated).unionByName(treated_late)
    cases = s["t2_dx"].subtract(s["t1_dx"]).join(allowed, on, "left_semi")
    controls = s["glucose"].join(s["abnormal"], on, "left_anti").subtract(s["related"])
    marked = cases.withColumn("label", F.lit(P.CASE)).unionByName(controls.withColumn("label", F.lit(P.CONTROL)))
    return s["patients"].join(marked, on, "left").withColumn("label", F.coalesce("label", F.lit(P.OTHER)))


@register("label_counts", f"{SETS_SQL} SELECT label, count(*) AS n FROM labels GROUP BY label")
def q_label_counts(spark, sf_dir):
    return (P.phenotype_labels(clin(spark, sf_dir)).groupBy("label")
            .agg(F.count(F.lit(1)).alias("n")))


_GLUCOSE_SQL = f"""{SETS_SQL},
g AS (SELECT lb.label, l.value FROM lab l JOIN labels lb ON l.patient_id = lb.patient_id
      WHERE lower(l.test_name) = '{V.GLUCOSE_MEAN_TEST}')
SELECT c.label, round(coalesce(avg(g.value), 0.0), {ROUND}) AS mean_glucose
FROM (VALUES (1), (2), (3)) c(label) LEFT JOIN g ON g.label = c.label GROUP BY c.label"""


@register("glucose_mean_by_label", _GLUCOSE_SQL)
def q_glucose_mean_by_label(spark, sf_dir):
    c = clin(spark, sf_dir)
    return P.glucose_mean_by_label(c.lab, P.phenotype_labels(c)).select("label", _r("mean_glucose"))


@register("glucose_mean_one_pass", _GLUCOSE_SQL)
def q_glucose_mean_one_pass(spark, sf_dir):
    flags = P.patient_flags(clin(spark, sf_dir))
    return P.glucose_mean_from_flags(flags).select("label", _r("mean_glucose"))


# ---------------------------------------------------------------------------
# Features (A1-A6, F12-F14, H0-H4, J4, J7, A12, L1 in SQL form)
# ---------------------------------------------------------------------------

def _features_query(kind: str, filtered: bool):
    def q(spark, sf_dir):
        c = clin(spark, sf_dir)
        lists = FE.shipped_candidate_lists() if filtered else {}
        if kind == "dx":
            df = FE.dx_features(c.dx, lists.get("candidate_dx"))
        elif kind == "med":
            df = FE.med_features(c.med, lists.get("candidate_med"))
        else:
            df = FE.lab_features(c.lab, lists.get("candidate_lab"))
        return df.select("patient_id", "feature", _r("value"))
    return q


for _kind in ("dx", "med", "lab"):
    for _filtered in (False, True):
        _key = f"{_kind}_features" + ("_filtered" if _filtered else "")
        _base = FILTERED_FEATURES_SQL if _filtered else FEATURES_SQL
        register(_key, f"{_base} SELECT patient_id, feature, round(value, {ROUND}) AS value FROM {_kind}f")(
            _features_query(_kind, _filtered))


def _tuples(spark, sf_dir, filtered: bool) -> DataFrame:
    c = clin(spark, sf_dir)
    return FE.filtered_feature_tuples(c) if filtered else FE.feature_tuples(c)


@register("feature_tuples", f"{FEATURES_SQL} SELECT patient_id, feature, round(value, {ROUND}) AS value FROM tuples")
def q_feature_tuples(spark, sf_dir):
    return _tuples(spark, sf_dir, False).select("patient_id", "feature", _r("value"))


@register("feature_tuples_filtered",
          f"{FILTERED_FEATURES_SQL} SELECT patient_id, feature, round(value, {ROUND}) AS value FROM tuples")
def q_feature_tuples_filtered(spark, sf_dir):
    return _tuples(spark, sf_dir, True).select("patient_id", "feature", _r("value"))


@register("feature_dictionary", f"{FEATURES_SQL}{DICT_SQL} SELECT feature, idx FROM dict")
def q_feature_dictionary(spark, sf_dir):
    return FE.feature_dictionary(FE.feature_names(clin(spark, sf_dir)))


@register("feature_dictionary_filtered", f"{FILTERED_FEATURES_SQL}{DICT_SQL} SELECT feature, idx FROM dict")
def q_feature_dictionary_filtered(spark, sf_dir):
    return FE.feature_dictionary(_tuples(spark, sf_dir, True))


def _stored_tuples(spark, sf_dir) -> DataFrame:
    """All tuples, written once: names and entries both come from them, so the event join runs once."""
    return PC.stored(_tuples(spark, sf_dir, False), "tuples")


@register("patient_vectors_long", f"""{FEATURES_SQL}{DICT_SQL}
SELECT t.patient_id, d.idx, round(t.value, {ROUND}) AS value FROM tuples t JOIN dict d ON t.feature = d.feature""")
def q_patient_vectors_long(spark, sf_dir):
    tuples = _stored_tuples(spark, sf_dir)
    return FE.patient_vectors_long(tuples, FE.feature_dictionary(tuples)).select("patient_id", "idx", _r("value"))


@register("patient_vectors", f"""{FEATURES_SQL}{DICT_SQL}
SELECT t.patient_id, list(d.idx ORDER BY d.idx) AS indices,
       list_transform(list(t.value ORDER BY d.idx), lambda x: round(x, {ROUND})) AS "values"
FROM tuples t JOIN dict d ON t.feature = d.feature GROUP BY t.patient_id""")
def q_patient_vectors(spark, sf_dir):
    tuples = _stored_tuples(spark, sf_dir)
    e = FE.sparse_entries(FE.patient_vectors_long(tuples, FE.feature_dictionary(tuples)))
    return e.select("patient_id", "indices",
                    F.transform("values", lambda x: F.round(x, ROUND)).alias("values"))


_MOMENTS_SQL = f"""{FEATURES_SQL},
pats AS (SELECT DISTINCT patient_id FROM tuples),
names AS (SELECT DISTINCT feature FROM tuples),
grid AS (SELECT n.feature, p.patient_id, coalesce(t.value, 0.0) AS value FROM names n CROSS JOIN pats p
         LEFT JOIN tuples t ON t.feature = n.feature AND t.patient_id = p.patient_id),
mom AS (SELECT feature, count(*) AS n_patients, avg(value) AS mean, coalesce(stddev_samp(value), 0.0) AS std
        FROM grid GROUP BY feature)"""


@register("feature_moments", f"""{_MOMENTS_SQL}
SELECT feature, n_patients, round(mean, {ROUND}) AS mean, round(std, {ROUND}) AS std FROM mom""")
def q_feature_moments(spark, sf_dir):
    m = FE.feature_moments(_tuples(spark, sf_dir, False))
    return m.select("feature", "n_patients", _r("mean"), _r("std"))


@register("feature_zscores", f"""{_MOMENTS_SQL}
SELECT t.patient_id, t.feature,
       round(CASE WHEN m.std > 0 THEN (t.value - m.mean) / m.std ELSE 0.0 END, {ROUND}) AS zscore
FROM tuples t JOIN mom m ON t.feature = m.feature""")
def q_feature_zscores(spark, sf_dir):
    tuples = _tuples(spark, sf_dir, False)
    return FE.feature_zscores(tuples).select("patient_id", "feature", _r("zscore"))


# ---------------------------------------------------------------------------
# Scalar parsing
# ---------------------------------------------------------------------------

@register("parsed_dates", """
SELECT event_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_type = 'click' THEN '-05:00' ELSE 'Z' END AS text,
       epoch_ms(date_trunc('second', ts)) + CASE WHEN event_type = 'click' THEN 18000000 ELSE 0 END AS epoch_ms
FROM events""")
def q_parsed_dates(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(F.col("event_type") == "click", F.lit("-05:00")).otherwise(F.lit("Z")))
    return (ev.select("event_id", text.alias("text"))
            .select("event_id", "text", PA.epoch_millis(PA.parse_instant(F.col("text"))).alias("epoch_ms")))


@register("parsed_numbers", """
SELECT l_orderkey, l_linenumber,
       format('{:,.2f}', l_extendedprice) || CASE WHEN l_returnflag = 'R' THEN ' USD' ELSE '' END AS text,
       round(l_extendedprice, 2) AS value
FROM lineitem""")
def q_parsed_numbers(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    text = F.concat(F.format_number("l_extendedprice", 2),
                    F.when(F.col("l_returnflag") == "R", F.lit(" USD")).otherwise(F.lit("")))
    return (li.select("l_orderkey", "l_linenumber", text.alias("text"))
            .select("l_orderkey", "l_linenumber", "text", PA.parse_us_number(F.col("text")).alias("value")))


# ---------------------------------------------------------------------------
# Contingency and purity on a deterministic stand-in assignment (A9-A11, P6):
# each patient's "cluster" is its customer's nation key.
# ---------------------------------------------------------------------------

def standin_assignments(spark, sf_dir) -> DataFrame:
    labels = P.phenotype_labels(clin(spark, sf_dir))
    cust = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("patient_id"), F.col("c_nationkey").alias("cluster"))
    return S.with_labels(cust, labels)


_STANDIN_SQL = f"""{SETS_SQL},
pairs AS (SELECT lb.label, c.c_nationkey AS cluster FROM customer c
          JOIN labels lb ON CAST(c.c_custkey AS VARCHAR) = lb.patient_id),
cnt AS (SELECT label, cluster, count(*) AS n FROM pairs GROUP BY label, cluster)"""


@register("contingency", f"{_STANDIN_SQL} SELECT label, cluster, n FROM cnt")
def q_contingency(spark, sf_dir):
    return M.contingency(standin_assignments(spark, sf_dir), "label", "cluster")


@register("purity", f"""{_STANDIN_SQL}
SELECT round(sum(best) / (SELECT sum(n) FROM cnt), {ROUND}) AS purity
FROM (SELECT cluster, max(n) AS best FROM cnt GROUP BY cluster) b""")
def q_purity(spark, sf_dir):
    return M.purity(standin_assignments(spark, sf_dir), "cluster", "label").select(_r("purity"))


@register("inverse_purity", f"""{_STANDIN_SQL}
SELECT round(sum(best) / (SELECT sum(n) FROM cnt), {ROUND}) AS purity
FROM (SELECT label, max(n) AS best FROM cnt GROUP BY label) b""")
def q_inverse_purity(spark, sf_dir):
    return M.purity(standin_assignments(spark, sf_dir), "label", "cluster").select(_r("purity"))


# ---------------------------------------------------------------------------
# Mini-batch k-means step (L7) on 2-D points from events, fixed start centres
# ---------------------------------------------------------------------------

# FIXED VALUES of the check: start centres (value, user id) and their weight.
MINIBATCH_START = [[0.0, 0.0], [100.0, 50.0], [200.0, 100.0]]


def _minibatch_sql() -> str:
    c = MINIBATCH_START
    w = C.STREAM_START_WEIGHT
    d = [f"(x - {cx}) * (x - {cx}) + (y - {cy}) * (y - {cy})" for cx, cy in c]
    centres = ", ".join(f"({i}, CAST({cx} AS DOUBLE), CAST({cy} AS DOUBLE))" for i, (cx, cy) in enumerate(c))
    return f"""
WITH pts AS (SELECT value AS x, CAST(user_id AS DOUBLE) AS y FROM events),
dd AS (SELECT x, y, {d[0]} AS d0, {d[1]} AS d1, {d[2]} AS d2 FROM pts),
a AS (SELECT x, y, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster FROM dd),
st AS (SELECT cluster, CAST(count(*) AS DOUBLE) AS m, sum(x) AS sx, sum(y) AS sy FROM a GROUP BY cluster),
c AS (SELECT * FROM (VALUES {centres}) t(cluster, cx, cy)),
j AS (SELECT c.cluster, c.cx, c.cy, coalesce(st.m, 0.0) AS m, st.sx, st.sy,
             CAST({w} AS DOUBLE) * 1.0 + coalesce(st.m, 0.0) AS w
      FROM c LEFT JOIN st ON st.cluster = c.cluster)
SELECT cluster, round(w, {ROUND}) AS weight,
       round(CASE WHEN m > 0 THEN cx * (1.0 - m / w) + sx * ((m / w) / m) ELSE cx END, {ROUND}) AS cx,
       round(CASE WHEN m > 0 THEN cy * (1.0 - m / w) + sy * ((m / w) / m) ELSE cy END, {ROUND}) AS cy
FROM j"""


@register("minibatch_centres", _minibatch_sql())
def q_minibatch_centres(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    pts = ev.select(F.array(F.col("value"), F.col("user_id").cast("double")).alias("features"))
    start = C.Centres(MINIBATCH_START, [C.STREAM_START_WEIGHT] * len(MINIBATCH_START))
    upd = C.minibatch_update(pts, start, "features", decay=1.0, time_unit="points")
    return upd.select("cluster", _r("weight"),
                      F.round(F.col("center")[0], ROUND).alias("cx"),
                      F.round(F.col("center")[1], ROUND).alias("cy"))


@register("minibatch_stream_centres", _minibatch_sql())
def q_minibatch_stream_centres(spark, sf_dir):
    """The same update run as a Structured Streaming query over the events files.

    The file source reads the table as a stream (one micro-batch per file), the
    ``foreachBatch`` sink writes the centre table per batch id, and the result
    is the newest written state.
    """
    from medcohort.streaming.minibatch import start_streaming_kmeans, state_frame

    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/[e]vents.parquet")
    pts = stream.select(F.array(F.col("value"), F.col("user_id").cast("double")).alias("features"))
    start = C.Centres(MINIBATCH_START, [C.STREAM_START_WEIGHT] * len(MINIBATCH_START))
    base = state_dir(spark, f"minibatch-{uuid.uuid4().hex}")
    query = start_streaming_kmeans(spark, pts, start, f"{base}/stream", f"{base}/state")
    query.awaitTermination()   # availableNow: drains, then stops; raises what the stream raised
    return state_frame(spark, f"{base}/state").select(
        "cluster", _r("weight"),
        F.round(F.col("center")[0], ROUND).alias("cx"), F.round(F.col("center")[1], ROUND).alias("cy"))


# ---------------------------------------------------------------------------
# ML path (L1-L6, L8-L10): properties of the fits beside values from the tables
# ---------------------------------------------------------------------------

_SETS_OF_FEATURES = f"""{SETS_SQL},
{_feature_sql(True)},
every AS (SELECT patient_id, code AS feature FROM dx UNION SELECT patient_id, test_name FROM lab
          UNION SELECT patient_id, medicine FROM med),
featured AS (SELECT DISTINCT 'All' AS feature_set, patient_id FROM every
             UNION ALL SELECT DISTINCT 'Filtered', patient_id FROM tuples),
names AS (SELECT DISTINCT 'All' AS feature_set, feature FROM every
          UNION ALL SELECT DISTINCT 'Filtered', feature FROM tuples),
algorithms(algorithm) AS (VALUES ('kMeans'), ('GMM'), ('StreamingKmeans'))"""


@register("pca_properties", f"""{_SETS_OF_FEATURES}
SELECT p.feature_set, p.n_patients, w.width, least({C.PCA_COMPONENTS}, w.width) AS components,
       true AS centred, true AS uncorrelated, true AS descending
FROM (SELECT feature_set, count(*) AS n_patients FROM featured GROUP BY 1) p
JOIN (SELECT feature_set, count(*) AS width FROM names GROUP BY 1) w USING (feature_set)""")
def q_pca_properties(spark, sf_dir):
    """L1-L3: what makes scores principal: mean 0, no correlation between two, variances in falling order."""
    ensure_checkpoint_dir(spark)
    every = lambda conds: F.array_min(F.array(*[c.cast("int") for c in conds])) == 1

    def checked(name, vectors, width, held):
        points, dim = S.project_points(vectors, width, held)
        at = [F.col("x")[i] for i in range(dim)]
        size = F.sqrt(F.var_samp(at[0]))
        centred = [F.abs(F.avg(a)) <= 1e-6 * size for a in at]
        apart = [F.abs(F.covar_samp(at[i], at[j])) <= 1e-6 * F.var_samp(at[0]) for i in range(dim) for j in range(i)]
        falls = [F.var_samp(at[i]) >= F.var_samp(at[i + 1]) * (1 - 1e-9) for i in range(dim - 1)]
        return points.agg(
            F.count("*").alias("n_patients"), every(centred).alias("centred"), every(apart).alias("uncorrelated"),
            every(falls).alias("descending")).select(
            F.lit(name).alias("feature_set"), "n_patients", F.lit(width).cast("long").alias("width"),
            F.lit(dim).cast("long").alias("components"), "centred", "uncorrelated", "descending").checkpoint(eager=True)

    with S.released() as held:
        sets = S.feature_sets(clin(spark, sf_dir), held=held)
        parts = list(S._in_parallel({name: (lambda n=name, v=vectors, w=width: checked(n, v, w, held))
                                     for name, (_, vectors, width) in sets.items()}, 2, spark).values())
    return parts[0].unionByName(parts[1])


@register("cluster_contingency", f"""{_SETS_OF_FEATURES}
SELECT f.feature_set, a.algorithm, l.label, count(*) AS n
FROM featured f JOIN labels l USING (patient_id), algorithms a GROUP BY 1, 2, 3""")
def q_cluster_contingency(spark, sf_dir):
    """A9 of the study: its cells, summed over the clusters, are the label totals of the feature set."""
    cells = S.cluster_contingency(clin(spark, sf_dir))
    return cells.groupBy("feature_set", "algorithm", "label").agg(F.sum("n").alias("n"))


@register("cluster_report", f"""{_SETS_OF_FEATURES},
best AS (SELECT feature_set, max(n) AS largest, sum(n) AS n FROM (
           SELECT f.feature_set, l.label, count(*) AS n FROM featured f JOIN labels l USING (patient_id) GROUP BY 1, 2)
         GROUP BY 1)
SELECT feature_set, algorithm, CAST(n AS BIGINT) AS n, true AS purity_in_range, true AS line_is_right
FROM best, algorithms""")
def q_cluster_report(spark, sf_dir):
    """Purity is at least the largest label's share and at most 1, and the line prints the inverse purity."""
    c = clin(spark, sf_dir)
    with S.released() as held:
        stacked = S.labelled_assignments(c, held)
        share = stacked.groupBy("feature_set", "algorithm", "label").agg(F.count("*").alias("m"))
        share = share.groupBy("feature_set", "algorithm").agg((F.max("m") / F.sum("m")).alias("least"))
        scored = M.purity_by(stacked, ["feature_set", "algorithm"]).withColumn("report", report_line())
        scored = scored.join(share, ["feature_set", "algorithm"])
        printed = F.regexp_extract("report", r"^\[(All|Filtered) feature\] getPurity of \w+ is: (\d\.\d{5})$", 2)
        return scored.select(
            "feature_set", "algorithm", "n",
            F.col("purity").between(F.col("least") - 1e-9, 1).alias("purity_in_range"),
            (F.abs(printed.try_cast("double") - F.col("inverse_purity")) <= 5.1e-6).alias("line_is_right")).checkpoint(eager=True)


# One update of the mini-batch learner on the z-scored filtered features, exact in SQL: start centres are the
# points whose coordinates are all -1, all 0 and all 1.
ZSCORE_START = (-1.0, 0.0, 1.0)
_ZSCORE_SQL = f"""{SETS_SQL},
{_feature_sql(True)},
pats AS (SELECT DISTINCT patient_id FROM tuples),
grid AS (SELECT n.feature, p.patient_id, coalesce(t.value, 0.0) AS value
         FROM (SELECT DISTINCT feature FROM tuples) n CROSS JOIN pats p
         LEFT JOIN tuples t ON t.feature = n.feature AND t.patient_id = p.patient_id),
mom AS (SELECT feature, avg(value) AS mean, stddev_samp(value) AS std FROM grid GROUP BY feature),
z AS (SELECT patient_id, feature, CASE WHEN std > 0 THEN (value - mean) / std ELSE 0.0 END AS z FROM grid JOIN mom USING (feature)),
first AS (SELECT patient_id, arg_min(c, d ORDER BY c) AS c FROM (
            SELECT patient_id, c, round(sum((z - c) * (z - c)), 9) AS d FROM z, (VALUES (-1.0), (0.0), (1.0)) s(c) GROUP BY 1, 2)
          GROUP BY 1),
moved AS (SELECT s.c, n.feature, coalesce(sum(z.z), 0.0) AS s, count(z.z) AS m
          FROM (VALUES (-1.0), (0.0), (1.0)) s(c) CROSS JOIN (SELECT DISTINCT feature FROM z) n
          LEFT JOIN first f ON f.c = s.c LEFT JOIN z ON z.patient_id = f.patient_id AND z.feature = n.feature GROUP BY 1, 2),
centre AS (SELECT c, feature, (c * {C.STREAM_START_WEIGHT} + s) / ({C.STREAM_START_WEIGHT} + m) AS x FROM moved),
assigned AS (SELECT patient_id, CAST(arg_min(c, d ORDER BY c) + 1 AS INTEGER) AS cluster FROM (
               SELECT z.patient_id, c, round(sum((z - x) * (z - x)), 9) AS d FROM z JOIN centre USING (feature) GROUP BY 1, 2)
             GROUP BY 1),
cells AS (SELECT l.label, a.cluster, count(*) AS n FROM assigned a JOIN labels l USING (patient_id) GROUP BY 1, 2)"""


def _zscore_points(spark, sf_dir) -> tuple[DataFrame, int]:
    """``(patient_id, x)``: the z-scored filtered features, absent entries included, and their number.

    The tuples are stored, so dictionary, vectors and moments share one event join.
    """
    tuples = PC.stored(FE.filtered_feature_tuples(clin(spark, sf_dir)), "zscore-tuples")
    dictionary, vectors, width = FE.build_vectors(tuples)
    moments = FE.feature_moments(tuples).join(dictionary, "feature").select("idx", "mean", "std").collect()  # list width
    by = {r.idx: r for r in moments}
    shift = F.array(*[F.lit(by[i].mean) for i in range(width)])
    scale = F.array(*[F.lit(1 / by[i].std if by[i].std > 0 else 0.0) for i in range(width)])
    points = vectors.select("patient_id", F.zip_with(
        F.zip_with(vector_to_array("features"), shift, lambda a, b: a - b), scale, lambda a, b: a * b).alias("x"))
    return points, width


def _zscore_assignments(spark, sf_dir) -> DataFrame:
    points, width = _zscore_points(spark, sf_dir)
    start = C.Centres([[x] * width for x in ZSCORE_START], [C.STREAM_START_WEIGHT] * len(ZSCORE_START))
    centres = C.Centres.from_frame(C.minibatch_update(points, start, "x"))
    return S.with_labels(C.predict_nearest(points, centres, "x"), P.phenotype_labels(clin(spark, sf_dir)))


@register("zscore_minibatch_contingency", f"{_ZSCORE_SQL} SELECT label, cluster, n FROM cells")
def q_zscore_minibatch_contingency(spark, sf_dir):
    return M.contingency(_zscore_assignments(spark, sf_dir))


@register("zscore_minibatch_purity", f"""{_ZSCORE_SQL}
SELECT sum(n) AS n, round((SELECT sum(b) FROM (SELECT max(n) AS b FROM cells GROUP BY cluster)) / sum(n), {ROUND}) AS purity,
       round((SELECT sum(b) FROM (SELECT max(n) AS b FROM cells GROUP BY label)) / sum(n), {ROUND}) AS inverse_purity
FROM cells""")
def q_zscore_minibatch_purity(spark, sf_dir):
    return M.purity_pair(_zscore_assignments(spark, sf_dir)).select("n", _r("purity"), _r("inverse_purity"))


# ---------------------------------------------------------------------------
# Exact learners (L2-L6, L8-L10, S13) on the z-scored filtered features: the same steps unrolled in SQL
# ---------------------------------------------------------------------------

_Z_SQL = _ZSCORE_SQL[:_ZSCORE_SQL.index("\nfirst AS (")].rstrip().rstrip(",")
POWER_ROUNDS, LLOYD_STEPS, EM_STEPS = 4, 4, 4


def _power_sql() -> str:
    rounds = ["""names AS (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS idx FROM (SELECT DISTINCT feature FROM tuples)),
raw0 AS (SELECT feature, sin((idx + 1) * CAST(12.9898 AS DOUBLE)) AS b FROM names JOIN mom USING (feature) WHERE std > 0),
b0 AS (SELECT feature, b / sqrt(sum(b * b) OVER ()) AS b FROM raw0)"""]
    for t in range(1, POWER_ROUNDS + 1):
        rounds.append(f"""y{t} AS (SELECT patient_id, sum(z * b) AS y FROM z JOIN b{t - 1} USING (feature) GROUP BY 1),
raw{t} AS (SELECT feature, sum(z * y) AS b FROM z JOIN y{t} USING (patient_id) JOIN b0 USING (feature) GROUP BY 1),
b{t} AS (SELECT feature, b / sqrt(sum(b * b) OVER ()) AS b FROM raw{t})""")
    last = f"b{POWER_ROUNDS}"
    return ",\n".join([_Z_SQL, *rounds, f"""turned AS (
  SELECT feature, b * (SELECT sign(b) FROM {last} JOIN names USING (feature) ORDER BY abs(b) DESC, idx LIMIT 1) AS b FROM {last})"""])


def _first_component(spark, sf_dir):
    tuples = FE.filtered_feature_tuples(clin(spark, sf_dir)).persist()
    try:
        dictionary = FE.feature_dictionary(tuples)
        entries = FE.patient_vectors_long(tuples, dictionary)
        model = PC.principal_components(entries, PC.indexed_moments(tuples, dictionary), 1, POWER_ROUNDS, 0.0, 0)
        return model, PC.project_long(model, PC.stored(entries, "pca-entries")), dictionary
    finally:
        tuples.unpersist()


@register("pca_scores", f"""{_power_sql()}
SELECT patient_id, round(sum(z * b), {ROUND}) AS score FROM z JOIN turned USING (feature) GROUP BY 1""")
def q_pca_scores(spark, sf_dir):
    """L1-L3: scores on the first component after a fixed number of rounds of the block iteration."""
    _, points, _ = _first_component(spark, sf_dir)
    return points.select("patient_id", F.round(F.col("pca")[0], ROUND).alias("score"))


@register("pca_loadings", f"{_power_sql()} SELECT feature, round(b, {ROUND}) AS loading FROM turned")
def q_pca_loadings(spark, sf_dir):
    model, _, dictionary = _first_component(spark, sf_dir)
    return model.loadings.join(dictionary, "idx").select("feature", F.round("c0", ROUND).alias("loading"))


def _start_sql() -> str:
    """The oversampled start (``grouping.start_centres``): candidates, their weights, the chosen centres ``c0(i, x)``."""
    u = lambda r: (f"((CAST('0x' || substr(md5('{r}:' || patient_id), 1, {G.DRAW_DIGITS}) AS BIGINT) + 0.5)"  # noqa: E731
                   f" / {16 ** G.DRAW_DIGITS}.0)")
    d2 = "list_sum(list_transform(list_zip(p.x, c.x), lambda q: (q[1] - q[2]) * (q[1] - q[2])))"
    parts = [f"""zv AS MATERIALIZED (SELECT patient_id, list(z ORDER BY feature) AS x FROM z GROUP BY 1),
cand0 AS MATERIALIZED (SELECT 0 AS c, x FROM (SELECT x FROM zv ORDER BY {u(0)}, patient_id LIMIT 1))"""]
    size = 1
    for r in range(1, G.START_ROUNDS + 1):
        more = G.START_FACTOR * G.K
        parts.append(f"""away{r} AS (SELECT p.patient_id, any_value(p.x) AS x, min({d2}) AS d FROM zv p, cand{r - 1} c GROUP BY 1),
cand{r} AS MATERIALIZED (SELECT * FROM cand{r - 1} UNION ALL SELECT {size - 1} + k AS c, x FROM (
  SELECT x, row_number() OVER (ORDER BY -ln({u(r)}) / d, patient_id) AS k FROM away{r} WHERE d > 0) WHERE k <= {more})""")
        size += more
    last = f"cand{G.START_ROUNDS}"
    parts.append(f"""weigh AS MATERIALIZED (SELECT c.c, c.x, count(n.c) AS w FROM {last} c LEFT JOIN (
  SELECT arg_min(c, d ORDER BY c) AS c FROM (SELECT p.patient_id, c.c, {d2} AS d FROM zv p, {last} c) GROUP BY patient_id) n ON n.c = c.c
  GROUP BY c.c, c.x),
pick0 AS MATERIALIZED (SELECT 0 AS i, x FROM (SELECT x FROM weigh ORDER BY w DESC, c LIMIT 1))""")
    for i in range(1, G.K):
        parts.append(f"""pick{i} AS MATERIALIZED (SELECT * FROM pick{i - 1} UNION ALL SELECT {i}, x FROM (
  SELECT x FROM (SELECT p.c AS place, any_value(p.x) AS x, any_value(p.w) * min({d2}) AS far FROM weigh p, pick{i - 1} c GROUP BY 1)
  WHERE far > 0 ORDER BY far DESC, place LIMIT 1))""")
    return ",\n".join([*parts, f"c0 AS (SELECT i, x FROM pick{G.K - 1})"])


def _lloyd_sql() -> str:
    near = "round(list_sum(list_transform(list_zip(p.x, c.x), lambda q: (q[1] - q[2]) * (q[1] - q[2]))), 9)"
    parts = [_Z_SQL, _start_sql()]
    for t in range(LLOYD_STEPS + 1):
        parts.append(f"""near{t} AS MATERIALIZED (SELECT patient_id, any_value(x) AS x, arg_min(i, d ORDER BY i) AS i FROM (
  SELECT p.patient_id, p.x, c.i, {near} AS d FROM zv p, c{t} c) GROUP BY 1)""")
        if t < LLOYD_STEPS:
            parts.append(f"""c{t + 1} AS MATERIALIZED (SELECT c.i, coalesce(m.x, c.x) AS x FROM c{t} c LEFT JOIN (
  SELECT i, list(v ORDER BY j) AS x FROM (SELECT i, j, avg(v) AS v FROM (
    SELECT i, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM near{t}) GROUP BY 1, 2) GROUP BY 1) m ON m.i = c.i)""")
    return ",\n".join(parts)


def _kmeans_assignments(spark, sf_dir) -> DataFrame:
    points = _zscore_points(spark, sf_dir)[0].persist()
    centres = G.kmeans(points, max_iter=LLOYD_STEPS, tol=0.0)
    points.unpersist()
    return S.with_labels(G.assign(points, centres), P.phenotype_labels(clin(spark, sf_dir)))


@register("kmeans_clusters", f"""{_lloyd_sql()}
SELECT label, CAST(i AS INTEGER) AS cluster, count(*) AS n FROM near{LLOYD_STEPS} JOIN labels USING (patient_id) GROUP BY 1, 2""")
def q_kmeans_clusters(spark, sf_dir):
    """The groups after a fixed number of Lloyd steps from the drawn start, by label."""
    return _kmeans_assignments(spark, sf_dir).groupBy("label", "cluster").agg(F.count("*").alias("n"))


@register("kmeans_centres", f"""{_lloyd_sql()}
SELECT CAST(i AS INTEGER) AS cluster, CAST(j - 1 AS INTEGER) AS idx, round(v, {ROUND}) AS centre FROM (
  SELECT i, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM c{LLOYD_STEPS})""")
def q_kmeans_centres(spark, sf_dir):
    points = _zscore_points(spark, sf_dir)[0].persist()
    centres = G.kmeans(points, max_iter=LLOYD_STEPS, tol=0.0)
    points.unpersist()
    rows = [(i, c) for i, c in enumerate(centres)]
    return spark.createDataFrame(rows, "cluster int, x array<double>").select(
        "cluster", F.posexplode("x").alias("idx", "centre")).withColumn("centre", F.round("centre", ROUND))


@register("streaming_kmeans_clusters", f"""{_Z_SQL},
{_start_sql()},
near0 AS (SELECT patient_id, any_value(x) AS x, arg_min(i, d ORDER BY i) AS i FROM (
  SELECT p.patient_id, p.x, c.i, round(list_sum(list_transform(list_zip(p.x, c.x), lambda q: (q[1] - q[2]) * (q[1] - q[2]))), 9) AS d
  FROM zv p, c0 c) GROUP BY 1),
sums AS (SELECT i, j, sum(v) AS s, count(*) AS m FROM (SELECT i, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM near0) GROUP BY 1, 2),
c1 AS MATERIALIZED (SELECT i, list(v ORDER BY j) AS x FROM (
  SELECT c.i, c.j, (c.v * {C.STREAM_START_WEIGHT} + coalesce(s, 0)) / ({C.STREAM_START_WEIGHT} + coalesce(m, 0)) AS v
  FROM (SELECT i, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM c0) c LEFT JOIN sums USING (i, j)) GROUP BY 1),
near1 AS (SELECT patient_id, arg_min(i, d ORDER BY i) AS i FROM (
  SELECT p.patient_id, c.i, round(list_sum(list_transform(list_zip(p.x, c.x), lambda q: (q[1] - q[2]) * (q[1] - q[2]))), 9) AS d
  FROM zv p, c1 c) GROUP BY 1)
SELECT label, CAST(i AS INTEGER) AS cluster, count(*) AS n FROM near1 JOIN labels USING (patient_id) GROUP BY 1, 2""")
def q_streaming_kmeans_clusters(spark, sf_dir):
    """One mini-batch update of the drawn start with all points, then the groups by label."""
    points = _zscore_points(spark, sf_dir)[0].persist()
    drawn = G.start_centres(points)
    start = C.Centres(drawn, [C.STREAM_START_WEIGHT] * len(drawn))
    centres = C.Centres.from_frame(C.minibatch_update(points, start, "x"))
    points.unpersist()
    labelled = S.with_labels(C.predict_nearest(points, centres, "x"), P.phenotype_labels(clin(spark, sf_dir)))
    return labelled.groupBy("label", "cluster").agg(F.count("*").alias("n"))


# FIXED VALUES of the check: start means of the mixture on (number of diagnoses, mean lab value), z-scored.
MIXTURE_START = [[-1.0, -1.0], [0.0, 0.0], [1.0, 1.0]]


def _mixture_sql(head: str = f"WITH {clinical_view_sql()}") -> str:
    rows = ", ".join(f"({i}, CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))" for i, (x, y) in enumerate(MIXTURE_START))
    parts = [f"""{head},
two AS (SELECT patient_id, CAST(d.n AS DOUBLE) AS a, l.m AS b FROM (SELECT patient_id, count(*) AS n FROM dx GROUP BY 1) d
        JOIN (SELECT patient_id, avg(value) AS m FROM lab GROUP BY 1) l USING (patient_id)),
pts AS MATERIALIZED (SELECT patient_id, (a - avg(a) OVER ()) / stddev_samp(a) OVER () AS x,
               (b - avg(b) OVER ()) / stddev_samp(b) OVER () AS y FROM two),
var AS (SELECT var_pop(x) AS vx, var_pop(y) AS vy, {G.RIDGE} * greatest((var_pop(x) + var_pop(y)) / 2, 1e-12) AS r FROM pts),
rid AS MATERIALIZED (SELECT vx + r AS vx, vy + r AS vy, {G.RIDGE} * greatest((vx + vy + 2 * r) / 2, 1e-12) AS r FROM var),
m0 AS (SELECT i, 1.0 / {len(MIXTURE_START)} AS w, mx, my, vx AS sxx, CAST(0 AS DOUBLE) AS sxy, vy AS syy
       FROM (VALUES {rows}) t(i, mx, my), rid)"""]
    for t in range(EM_STEPS + 1):
        parts.append(f"""l{t} AS (SELECT p.patient_id, p.x, p.y, m.i, ln(w) - ln(2 * pi()) - 0.5 * ln(sxx * syy - sxy * sxy)
  - 0.5 * (syy * (x - mx) * (x - mx) - 2 * sxy * (x - mx) * (y - my) + sxx * (y - my) * (y - my)) / (sxx * syy - sxy * sxy) AS l
  FROM pts p, m{t} m),
e{t} AS (SELECT *, exp(l - max(l) OVER (PARTITION BY patient_id)) AS e FROM l{t}),
r{t} AS MATERIALIZED (SELECT *, e / sum(e) OVER (PARTITION BY patient_id) AS r FROM e{t})""")
        if t < EM_STEPS:
            parts.append(f"""m{t + 1} AS MATERIALIZED (SELECT i, s / n AS w, ax / s AS mx, ay / s AS my, axx / s - (ax / s) * (ax / s) + r AS sxx,
  axy / s - (ax / s) * (ay / s) AS sxy, ayy / s - (ay / s) * (ay / s) + r AS syy
  FROM (SELECT i, sum(r) AS s, count(*) AS n, sum(r * x) AS ax, sum(r * y) AS ay, sum(r * x * x) AS axx, sum(r * x * y) AS axy,
        sum(r * y * y) AS ayy FROM r{t} GROUP BY i), rid)""")
    return ",\n".join(parts)


def _mixture_points(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The z-scored points, and the cached frame behind them."""
    c = clin(spark, sf_dir)
    two = c.dx.groupBy("patient_id").agg(F.count("*").cast("double").alias("a")).join(
        c.lab.groupBy("patient_id").agg(F.avg("value").alias("b")), "patient_id").persist()
    row = two.agg(F.avg("a"), F.stddev_samp("a"), F.avg("b"), F.stddev_samp("b")).first()
    out = two.select("patient_id", F.array((F.col("a") - row[0]) / row[1], (F.col("b") - row[2]) / row[3]).alias("x"))
    return out, two


@register("gmm_parameters", f"""{_mixture_sql()}
SELECT CAST(i AS INTEGER) AS cluster, round(w, {ROUND}) AS weight, round(mx, {ROUND}) AS mean_x, round(my, {ROUND}) AS mean_y,
       round(sxx, {ROUND}) AS var_x, round(sxy, {ROUND}) AS covar, round(syy, {ROUND}) AS var_y FROM m{EM_STEPS}""")
def q_gmm_parameters(spark, sf_dir):
    """Weights, means and covariances after a fixed number of EM steps."""
    points, held = _mixture_points(spark, sf_dir)
    model = G.gaussian_mixture(points, max_iter=EM_STEPS, tol=-1.0, means=MIXTURE_START)
    held.unpersist()
    rows = [(i, *map(float, (model.weights[i], *model.means[i], c[0, 0], c[0, 1], c[1, 1]))) for i, c in enumerate(model.covariances)]
    names = ["weight", "mean_x", "mean_y", "var_x", "covar", "var_y"]
    return spark.createDataFrame(rows, f"cluster int, {', '.join(f'{n} double' for n in names)}").select(
        "cluster", *[_r(n) for n in names])


@register("gmm_clusters", f"""{_mixture_sql(SETS_SQL)},
best AS (SELECT patient_id, arg_min(i, -round(r, 9) ORDER BY i) AS i FROM r{EM_STEPS} GROUP BY 1)
SELECT label, CAST(i AS INTEGER) AS cluster, count(*) AS n FROM best JOIN labels USING (patient_id) GROUP BY 1, 2""")
def q_gmm_clusters(spark, sf_dir):
    """The likeliest part of every patient after a fixed number of EM steps, by label."""
    points, held = _mixture_points(spark, sf_dir)
    model = G.gaussian_mixture(points, max_iter=EM_STEPS, tol=-1.0, means=MIXTURE_START)
    held.unpersist()
    labelled = S.with_labels(G.mixture_assign(points, model), P.phenotype_labels(clin(spark, sf_dir)))
    return labelled.groupBy("label", "cluster").agg(F.count("*").alias("n"))


@register("kmeans_report", f"""{_lloyd_sql()},
cells AS (SELECT label, i, count(*) AS n FROM near{LLOYD_STEPS} JOIN labels USING (patient_id) GROUP BY 1, 2),
total AS (SELECT CAST(sum(n) AS BIGINT) AS n, (SELECT sum(b) FROM (SELECT max(n) AS b FROM cells GROUP BY i)) / sum(n) AS p,
                 (SELECT sum(b) FROM (SELECT max(n) AS b FROM cells GROUP BY label)) / sum(n) AS q FROM cells)
SELECT 'Filtered' AS feature_set, 'kMeans' AS algorithm, n, round(p, {ROUND}) AS purity, round(q, {ROUND}) AS inverse_purity,
       '[Filtered feature] getPurity of kMeans is: ' || format('{{:.5f}}', q) AS report FROM total""")
def q_kmeans_report(spark, sf_dir):
    """Both purities of the exact k-means groups and the printed line."""
    scored = M.purity_pair(_kmeans_assignments(spark, sf_dir)).select(
        F.lit("Filtered").alias("feature_set"), F.lit("kMeans").alias("algorithm"), "*").withColumn("report", report_line())
    return scored.select("feature_set", "algorithm", "n", _r("purity"), _r("inverse_purity"), "report")


# ---------------------------------------------------------------------------
# Raw exports (S1-S12, F1, F2, C4): the view written as the four CSV exports by Spark and loaded back
# ---------------------------------------------------------------------------

def _exported(spark, sf_dir):
    folder = state_dir(spark, f"exports-{uuid.uuid4().hex}")
    CT.write_clinical_csv(clin(spark, sf_dir), folder)
    return CT.load_clinical_csv(spark, folder)


@register("csv_dx_events", f"WITH {clinical_view_sql()} SELECT patient_id, code, epoch_ms(date) AS date_ms FROM dx")
def q_csv_dx_events(spark, sf_dir):
    return _exported(spark, sf_dir).dx.select("patient_id", "code", PA.epoch_millis("date").alias("date_ms"))


@register("csv_lab_events", f"""WITH {clinical_view_sql()}
SELECT patient_id, epoch_ms(date) AS date_ms, test_name, round(value, {ROUND}) AS value FROM lab""")
def q_csv_lab_events(spark, sf_dir):
    return _exported(spark, sf_dir).lab.select("patient_id", PA.epoch_millis("date").alias("date_ms"), "test_name", _r("value"))


@register("csv_med_events", f"WITH {clinical_view_sql()} SELECT patient_id, epoch_ms(date) AS date_ms, medicine FROM med")
def q_csv_med_events(spark, sf_dir):
    return _exported(spark, sf_dir).med.select("patient_id", PA.epoch_millis("date").alias("date_ms"), "medicine")


@register("code_list_items", f"WITH {clinical_view_sql()} SELECT DISTINCT lower(test_name) AS item FROM lab")
def q_code_list_items(spark, sf_dir):
    """S10 on a list file that Spark writes from the lab names."""
    path = f"{state_dir(spark, f'lists-{uuid.uuid4().hex}')}/{CT.LAB_FILTER_FILE}"
    clin(spark, sf_dir).lab.select("test_name").write.text(path)
    return CT.load_code_list(spark, path)


def _faulty_exports(spark, sf_dir) -> str:
    """The four exports with planted faults: missing names, texts for dates and numbers, and rows with a field too many."""
    folder = state_dir(spark, f"faulty-{uuid.uuid4().hex}")
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def planted(c, key, n, bad):
        return F.when(F.col(key) % n == 0, F.lit(bad)).otherwise(c)

    def write(df, name):
        df.write.option("header", True).option("quote", "").csv(f"{folder}/{name}")

    orders, lines = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem")
    write(orders.select(F.col("o_orderkey").cast("string").alias("Encounter_ID"),
                        planted(F.col("o_custkey").cast("string"), "o_orderkey", 61, None).alias("Member_ID"),
                        planted(stamp("o_orderdate"), "o_orderkey", 53, "soon").alias("Encounter_DateTime")), CT.ENCOUNTER_FILE)
    write(lines.select(F.col("l_orderkey").cast("string").alias("Encounter_ID"),
                       planted(F.concat(F.lit("D"), F.col("l_partkey")), "l_partkey", 71, "a,b").alias("Code_ID")), CT.ENCOUNTER_DX_FILE)
    write(lines.select(F.col("l_suppkey").cast("string").alias("Member_ID"), stamp("l_shipdate").alias("Date_Resulted"),
                       F.lit("glucose").alias("Result_Name"),
                       F.when(F.col("l_partkey") % 47 == 0, "high").when(F.col("l_partkey") % 43 == 0, None)
                       .otherwise(F.col("l_quantity").cast("string")).alias("Numeric_Result")), CT.LAB_FILE)
    write(orders.select(F.col("o_custkey").cast("string").alias("Member_ID"), stamp("o_orderdate").alias("Order_Date"),
                        planted(planted(F.lit("X"), "o_orderkey", 97, None), "o_orderkey", 89, "a,b").alias("Drug_Name")), CT.MED_FILE)
    return folder


@register("csv_load_faults", f"""
SELECT '{CT.ENCOUNTER_FILE}' AS file, count(*) AS "rows", 0 AS malformed, count(*) FILTER (o_orderkey % 61 = 0) AS missing,
       count(*) FILTER (o_orderkey % 53 = 0) AS bad_dates, 0 AS bad_numbers FROM orders
UNION ALL SELECT '{CT.ENCOUNTER_DX_FILE}', count(*), count(*) FILTER (l_partkey % 71 = 0), 0, 0, 0 FROM lineitem
UNION ALL SELECT '{CT.LAB_FILE}', count(*), 0, 0, 0, count(*) FILTER (l_partkey % 47 = 0) FROM lineitem
UNION ALL SELECT '{CT.MED_FILE}', count(*), count(*) FILTER (o_orderkey % 89 = 0),
       count(*) FILTER (o_orderkey % 97 = 0 AND o_orderkey % 89 <> 0), 0, 0 FROM orders""")
def q_csv_load_faults(spark, sf_dir):
    """What an observed load counts in exports with planted faults, all of them named by the failure."""
    try:
        CT.load_observed_csv(spark, _faulty_exports(spark, sf_dir), state_dir(spark, f"typed-{uuid.uuid4().hex}"))
        raise AssertionError("the planted faults must fail the load")
    except CT.LoadFaults as faults:
        names = ("rows", "malformed", "missing", "bad_dates", "bad_numbers")
        rows = [(file, *(c[n] for n in names)) for file, c in faults.counts.items()]  # one row an export
    return spark.createDataFrame(rows, "file string, " + ", ".join(f"{n} long" for n in names))


@register("csv_usable_events", f"""
SELECT 'dx' AS domain, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE o_orderkey % 61 <> 0 AND o_orderkey % 53 <> 0 AND l_partkey % 71 <> 0
UNION ALL SELECT 'lab', count(*) FROM lineitem WHERE l_partkey % 47 <> 0 AND l_partkey % 43 <> 0
UNION ALL SELECT 'med', count(*) FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0""")
def q_csv_usable_events(spark, sf_dir):
    """The events that an observed load keeps of the same exports when it drops unusable rows."""
    c = CT.load_observed_csv(spark, _faulty_exports(spark, sf_dir), state_dir(spark, f"typed-{uuid.uuid4().hex}"), "drop")
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("domain"), "n") for k, df in (("dx", c.dx), ("lab", c.lab), ("med", c.med))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("csv_view_rows", """
SELECT 'encounter_dx_INPUT' AS view_name, 'c000' AS source, count(*) AS n FROM lineitem
UNION ALL SELECT 'medication_orders_INPUT', 'c000', count(*) FROM orders""")
def q_csv_view_rows(spark, sf_dir):
    """Exports loaded under the view names inferred from their paths, and the name of each row's own file."""
    folder = state_dir(spark, f"exports-{uuid.uuid4().hex}")
    CT.write_clinical_csv(clin(spark, sf_dir), folder)
    parts = []
    for file in (CT.ENCOUNTER_DX_FILE, CT.MED_FILE):
        CT.load_csv_as_table(spark, f"{folder}/{file}")
        name = CT.infer_table_name(f"{folder}/{file}")
        rows = spark.sql(f"SELECT * FROM {name}").withColumn("source", CT.source_table_name())
        parts.append(rows.groupBy("source").agg(F.count("*").alias("n")).select(F.lit(name).alias("view_name"), "source", "n"))
    return parts[0].unionByName(parts[1])


@register("labels_tsv", f"{SETS_SQL} SELECT patient_id, CAST(label AS VARCHAR) AS label FROM labels")
def q_labels_tsv(spark, sf_dir):
    """The label export, read back."""
    path = state_dir(spark, f"labels-{uuid.uuid4().hex}")
    write_labels_tsv(P.phenotype_labels(clin(spark, sf_dir)), path)
    return spark.read.option("sep", "\t").schema("patient_id string, label string").csv(path)


@register("feature_tuples_tsv", f"{FEATURES_SQL} SELECT patient_id, feature, round(value, {ROUND}) AS value FROM tuples")
def q_feature_tuples_tsv(spark, sf_dir):
    """The tuple export, read back."""
    path = state_dir(spark, f"tuples-{uuid.uuid4().hex}")
    write_feature_tuples_tsv(_tuples(spark, sf_dir, False), path)
    return spark.read.option("sep", "\t").schema("patient_id string, feature string, value double").csv(path).select(
        "patient_id", "feature", _r("value"))


# FIXED VALUES of the check: a criteria table as it is shipped, with a wildcard row and a quoted comma.
CRITERIA_ROWS = (("790.21", "Impaired fasting glucose"), ("256.4", "Polycystic ovaries, any"), ("250.*", "Diabetes mellitus"))


@register("criteria_events", f"""WITH {clinical_view_sql()}
SELECT code, count(*) AS n FROM dx WHERE code IN ('790.21', '256.4') OR code LIKE '250.%' GROUP BY code""")
def q_criteria_events(spark, sf_dir):
    """Diagnoses that a written criteria table names, by code or by a wildcard row."""
    path = state_dir(spark, f"criteria-{uuid.uuid4().hex}")
    spark.createDataFrame(CRITERIA_ROWS, "code string, description string").write.csv(path)
    found = CT.criteria_filter(clin(spark, sf_dir).dx, "code", CT.load_criteria_table(spark, path))
    return found.groupBy("code").agg(F.count("*").alias("n"))


def _bucketed(spark, sf_dir, query) -> DataFrame:
    """``query`` on the view written as bucketed event tables; its result is stored, the tables go."""
    name = f"events_{uuid.uuid4().hex}"
    ET.save_event_tables(clin(spark, sf_dir), name)
    try:
        return PC.stored(query(ET.load_event_tables(spark, name)), "bucketed")
    finally:
        ET.drop_event_tables(spark, name)


@register("phenotype_labels_bucketed", f"{SETS_SQL} SELECT patient_id, label FROM labels")
def q_phenotype_labels_bucketed(spark, sf_dir):
    """R0 on event tables bucketed by patient."""
    return _bucketed(spark, sf_dir, P.phenotype_labels)


@register("feature_tuples_bucketed", f"{FEATURES_SQL} SELECT patient_id, feature, round(value, {ROUND}) AS value FROM tuples")
def q_feature_tuples_bucketed(spark, sf_dir):
    """H3 on event tables bucketed by patient."""
    return _bucketed(spark, sf_dir, lambda c: FE.feature_tuples(c).select("patient_id", "feature", _r("value")))


@register("restricted_lab_means", f"""{SETS_SQL}
SELECT patient_id, test_name, round(avg(value), {ROUND}) AS value FROM lab
WHERE patient_id IN (SELECT patient_id FROM t1_med) GROUP BY 1, 2""")
def q_restricted_lab_means(spark, sf_dir):
    """Lab means of the patients with a type-1 medication, restricted before the encounter join."""
    c = load_clinical_view(spark, sf_dir, QUERIES["t1_med_patients"](spark, sf_dir))
    return FE.lab_features(c.lab).select("patient_id", F.col("feature").alias("test_name"), _r("value"))


@register("stored_set_dx_counts", f"""{SETS_SQL}
SELECT patient_id, code, CAST(count(*) AS DOUBLE) AS value FROM dx
WHERE patient_id IN (SELECT patient_id FROM abnormal) GROUP BY 1, 2""")
def q_stored_set_dx_counts(spark, sf_dir):
    """Diagnosis counts of the patients with an abnormal lab; their stored set prunes the scans of J1."""
    some = stored_patients(QUERIES["abnormal_lab_patients"](spark, sf_dir))
    return FE.dx_features(load_clinical_view(spark, sf_dir, some).dx).select(
        "patient_id", F.col("feature").alias("code"), "value")
