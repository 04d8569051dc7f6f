"""Property-based checks of the rewrites against small pure-Python models.

Each drawn example is evaluated in ONE Spark job (all rows in one frame), and
the number of examples is kept small: Spark round trips dominate.
"""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from binyard import config as C
from binyard.functions import semantics as s
from binyard.operators.pack_split import pack_split

SETTINGS = settings(max_examples=25, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

maybe_int = st.one_of(st.none(), st.integers(-1000, 1000))
maybe_double = st.one_of(st.none(), st.just(float("nan")),
                         st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False))


def r_strict_sum(xs):
    return None if any(x is None for x in xs) else sum(xs)


def r_sum_na_rm(xs):
    vals = [x for x in xs if x is not None and not (isinstance(x, float) and math.isnan(x))]
    return float(sum(vals)) if vals else 0.0


@SETTINGS
@given(groups=st.lists(st.lists(maybe_int, min_size=1, max_size=6), min_size=1, max_size=8))
def test_strict_sum_matches_r(spark, groups):
    rows = [(g, v) for g, vs in enumerate(groups) for v in vs]
    df = spark.createDataFrame(rows, "g int, v int")
    got = {r.g: r.x for r in df.groupBy("g").agg(s.strict_sum("v").alias("x")).collect()}
    assert got == {g: r_strict_sum(vs) for g, vs in enumerate(groups)}


@SETTINGS
@given(groups=st.lists(st.lists(maybe_double, min_size=1, max_size=6), min_size=1, max_size=8))
def test_sum_or_zero_matches_r_na_rm(spark, groups):
    rows = [(g, v) for g, vs in enumerate(groups) for v in vs]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: r.x for r in df.groupBy("g").agg(s.sum_or_zero("v").alias("x")).collect()}
    for g, vs in enumerate(groups):
        assert math.isclose(got[g], r_sum_na_rm(vs), rel_tol=1e-9, abs_tol=1e-6)


def r_divide(n, d):
    if n is None or d is None:
        return None
    if d == 0:
        if math.isnan(n) or n == 0:
            return float("nan")
        return math.copysign(float("inf"), n)
    return n / d


@SETTINGS
@given(pairs=st.lists(st.tuples(maybe_double, st.one_of(st.just(0.0), maybe_double)),
                      min_size=1, max_size=20))
def test_ieee_div_matches_r(spark, pairs):
    df = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(pairs)],
                               "i int, n double, d double")
    got = {r.i: r.x for r in df.select("i", s.ieee_div("n", "d").alias("x")).collect()}
    for i, (n, d) in enumerate(pairs):
        want = r_divide(n, d)
        if want is None:
            assert got[i] is None
        elif math.isnan(want):
            assert math.isnan(got[i])
        else:
            assert got[i] == want


@SETTINGS
@given(xs=st.lists(st.integers(-4000, 4000), min_size=1, max_size=30))
def test_half_even_matches_r_round(spark, xs):
    vals = [x / 4 for x in xs]                     # many exact .5 ties
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = {r.i: r.x for r in df.select("i", s.half_even("v", 0).alias("x")).collect()}
    assert got == {i: float(round(v)) for i, v in enumerate(vals)}   # Python round: half-even


def r_as_integer(text):
    try:
        d = float(text)
    except (TypeError, ValueError):
        return None
    if math.isnan(d) or not (-2147483648 < d < 2147483648):
        return None
    return int(d)                                  # truncation toward zero


@SETTINGS
@given(texts=st.lists(st.one_of(
    st.none(), st.integers(-10**11, 10**11).map(str),
    st.floats(-1e10, 1e10, allow_nan=False).map(lambda f: f"{f:.3f}"),
    st.text(alphabet="abc-.", min_size=1, max_size=4)), min_size=1, max_size=20))
def test_to_int_matches_r_as_integer(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.x for r in df.select("i", s.to_int("t").alias("x")).collect()}
    assert got == {i: r_as_integer(t) for i, t in enumerate(texts)}


codes = st.one_of(st.none(), st.sampled_from(
    ["ROC999A", "roc999b", "Roc999", "ROC99", "JAP1", "jap2", "RKT7", "rkt", "TUB3", "XROC999"]))


def pivot_model(rows, tempz_first):
    """The reference's way: per (batch, code) sums, a wide frame with one
    column per code (NULL code -> column 'NA'), gaps 0, prefix row sums."""
    df = pd.DataFrame(rows, columns=["batch", "code", "units"])
    df["code"] = df["code"].fillna("NA")
    wide = df.pivot_table(index="batch", columns="code", values="units", aggfunc="sum",
                          fill_value=0.0)
    out = {}
    for batch, row in wide.iterrows():
        def pref(p):
            return float(sum(v for c, v in row.items() if c.upper().startswith(p)))
        export = pref(C.EXPORT_BIN_PREFIX)
        japan = float(round(pref(C.JAPAN_TRAY_PREFIX)))
        tempz = pref(C.TEMPZ_PREFIX) if batch >= tempz_first else 0.0
        tube = float(round(float(row.sum()) - export - japan - tempz))
        out[batch] = (tube, export, japan, tempz)
    return out


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from([2428, 2429, 2430, 2431]), codes,
                               st.integers(0, 40).map(lambda x: x / 4)),
                     min_size=1, max_size=30))
def test_pack_split_matches_pivot_model(spark, rows):
    df = spark.createDataFrame(rows, "batch int, code string, units double")
    got = {r.batch: (r.tubePacks, r.exportBins, r.japanTrayPacks, r.tempZPacks)
           for r in pack_split(df, "batch", "code", "units",
                               export_prefix=C.EXPORT_BIN_PREFIX,
                               japan_prefix=C.JAPAN_TRAY_PREFIX, tempz_prefix=C.TEMPZ_PREFIX,
                               tempz_first_key=2430).collect()}
    assert got == pivot_model(rows, 2430)


@SETTINGS
@given(wanted=st.sets(st.integers(2018, 2025), max_size=6),
       stamps=st.lists(st.tuples(st.integers(2018, 2025), st.integers(1, 12), st.integers(1, 28),
                                 st.integers(0, 23)), min_size=1, max_size=20))
def test_timestamp_band_filter_matches_year_membership(spark, wanted, stamps):
    """OR-ed half-open ranges (adjacent years merged) keep exactly the rows
    whose calendar year is requested and inside the configured bands."""
    import datetime as dt
    rows = [(i, dt.datetime(y, m, d, h)) for i, (y, m, d, h) in enumerate(stamps)]
    df = spark.createDataFrame(rows, "i int, t timestamp_ntz")
    got = sorted(r.i for r in df.filter(s.timestamp_season_filter("t", wanted)).collect())
    bands = set(C.CURRENT_SEASON_CODES.values())
    assert got == sorted(i for i, t in rows if t.year in wanted and t.year in bands)


_WS = " \t\n\u00a0\u2003"   # space, tab, newline, no-break space, em space


def r_norm_owner(text):
    """str_trim (Unicode white space, both ends), str_to_lower, delete ' '."""
    if text is None:
        return None
    return text.strip(_WS).lower().replace(" ", "")


@SETTINGS
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet=_WS + "AbC&()#-9", max_size=12)),
                      min_size=1, max_size=20))
def test_norm_owner_matches_r(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.x for r in df.select("i", s.norm_owner("t").alias("x")).collect()}
    assert got == {i: r_norm_owner(t) for i, t in enumerate(texts)}
