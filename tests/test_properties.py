"""Property tests: random event sets, including a hot patient with a third of the rows,
against a plain-Python statement of the rule and of the feature aggregates."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from medcohort.functions import valuesets as V
from medcohort.operators import features as FE
from medcohort.operators import phenotype as P
from medcohort.sources.clinical import ClinicalFrames

PATIENTS = ["hot", "p1", "p2", "p3", "p4"]
CODES = ["250.01", "250.00", "250.2", "250.10", "250", "V77.1", "790.21", "D1"]
MEDS = ["lantus", "metformin", "glucatrol ", "glucatrol", "insulin,ultralente", "drug 4"]
LABS = ["Glucose", "glucose", "HbA1c", "Fasting Glucose", "urine glucose", "Glucose, Serum", "lab 7"]
VALUES = [5.9, 6.0, 90.0, 110.0, 110.5]
DAYS = [dt.datetime(2020, 1, d) for d in (1, 2, 3)]

event = st.tuples(st.sampled_from(PATIENTS[1:]), st.integers(0, 2), st.integers(0, 7), st.integers(0, 6),
                  st.integers(0, 4))


def brute_labels(dx, med, lab):
    pats = {p for p, *_ in dx} | {p for p, *_ in med} | {p for p, *_ in lab}
    out = {}
    for p in pats:
        codes = {c for q, c, _ in dx if q == p}
        t1 = [d for q, d, m in med if q == p and m in V.T1DM_MED]
        t2 = [d for q, d, m in med if q == p and m in V.T2DM_MED]
        base = bool(codes & set(V.T2DM_DX)) and not codes & set(V.T1DM_DX)
        case = base and (not t1 or (t1 and not t2) or (min(t1) > min(t2)))
        labs = [(n.lower(), v) for q, _, n, v in lab if q == p]
        glucose = any("glucose" in n for n, _ in labs)
        abnormal = any((n == t and (v >= th if op == ">=" else v > th))
                       for n, v in labs for t, op, th in V.ABNORMAL_LAB_RULES)
        related = any(c in V.DM_RELATED_DX or c.startswith("250.") for c in codes)
        out[p] = 1 if case else (2 if glucose and not abnormal and not related else 3)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=3, max_size=30), st.integers(0, 7), st.integers(0, 5))
def test_rule_and_features_against_brute_force(spark, events, hot_code, hot_med):
    dx, med, lab = [], [], []
    for p, d, c, m, v in events:
        dx.append((p, CODES[c], DAYS[d]))
        med.append((p, DAYS[d], MEDS[m % len(MEDS)]))
        lab.append((p, DAYS[d], LABS[m], VALUES[v]))
    # the hot patient holds a third of every event set
    n = max(1, len(events) // 2)
    dx += [("hot", CODES[hot_code], DAYS[0])] * n
    med += [("hot", DAYS[i % 3], MEDS[hot_med]) for i in range(n)]
    lab += [("hot", DAYS[0], LABS[hot_med], VALUES[i % 5]) for i in range(n)]
    frames = ClinicalFrames(
        med=spark.createDataFrame(med, "patient_id string, date timestamp, medicine string"),
        lab=spark.createDataFrame(lab, "patient_id string, date timestamp, test_name string, value double"),
        dx=spark.createDataFrame(dx, "patient_id string, code string, date timestamp"))
    expected = brute_labels(dx, med, lab)
    assert {r.patient_id: r.label for r in P.phenotype_labels(frames).collect()} == expected

    got = {(r.patient_id, r.feature): r.value for r in FE.feature_tuples(frames).collect()}
    want = {}
    for p, c, _ in dx:
        want[(p, c)] = want.get((p, c), 0.0) + 1
    for p, _, m in med:
        want[(p, m)] = want.get((p, m), 0.0) + 1
    sums = {}
    for p, _, name, v in lab:
        s, k = sums.get((p, name), (0.0, 0))
        sums[(p, name)] = (s + v, k + 1)
    for key, (s, k) in sums.items():
        want[key] = s / k
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def _py_us_number(text):
    """Leading US number: optional minus, digits with commas, fraction, exponent; rest ignored."""
    import re
    if text.strip() == "NaN":
        return float("nan")
    m = re.match(r"-?[0-9,]*(\.[0-9]*)?(E-?[0-9]+)?", text)
    head = m.group(0).replace(",", "") if m else ""
    if not any(ch.isdigit() for ch in head):
        return None
    try:
        return float(head)
    except ValueError:
        return float(re.match(r"-?[0-9]*\.?[0-9]*", head).group(0))


number_text = st.builds(
    lambda neg, whole, frac, junk: ("-" if neg else "") + f"{whole:,}" + (f".{frac}" if frac is not None else "") + junk,
    st.booleans(), st.integers(0, 10**9), st.one_of(st.none(), st.integers(0, 999)),
    st.sampled_from(["", " USD", "abc", "%", "  "]))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(number_text, min_size=1, max_size=40))
def test_us_number_parse_matches_python(spark, texts):
    from pyspark.sql import functions as F

    from medcohort.functions.parsing import parse_us_number
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.v for r in df.select(parse_us_number(F.col("s"), "null").alias("v")).collect()]
    assert got == [_py_us_number(t) for t in texts]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.datetimes(min_value=dt.datetime(1970, 1, 2), max_value=dt.datetime(2100, 1, 1)),
                          st.integers(-12, 12), st.sampled_from(["X", "XXX"])), min_size=1, max_size=30))
def test_instant_parse_matches_python(spark, items):
    from pyspark.sql import functions as F

    from medcohort.functions.parsing import epoch_millis, parse_instant
    texts, want = [], []
    for t, off, style in items:
        t = t.replace(microsecond=0)
        zone = "Z" if off == 0 else (f"{off:+03d}" if style == "X" else f"{off:+03d}:00")
        texts.append(t.strftime("%Y-%m-%dT%H:%M:%S") + zone)
        utc = t - dt.timedelta(hours=off)
        want.append(int((utc - dt.datetime(1970, 1, 1)).total_seconds() * 1000))
    df = spark.createDataFrame([(s,) for s in texts], "s string")
    got = [r.v for r in df.select(epoch_millis(parse_instant(F.col("s"))).alias("v")).collect()]
    assert got == want
