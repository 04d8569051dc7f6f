"""Column-expression builders carrying the reports' value semantics.

Every function here returns a ``pyspark.sql.Column`` built from built-in
functions only, so it stays inside whole-stage codegen and Catalyst can push,
fold and prune around it.  No UDFs.

The null/rounding rules follow the reference, which mixes two worlds: sums run
by the SQL server (all-NULL group -> NULL) and sums run locally in R
(``na.rm = TRUE``: NULL and NaN skipped, empty -> 0; without ``na.rm``: any
NULL poisons the group).  Each helper names the rule it implements.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from binyard.config import DEFAULT_CONFIG, ReportConfig

_INT_MIN_EXCLUSIVE = -2147483648.0  # R's NA_integer_ is the int32 minimum
_INT_MAX_EXCLUSIVE = 2147483648.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- nulls, NaN


def nan_to_null(c) -> Column:
    """NaN -> NULL, so R's "NaN is missing" rule applies."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def fill_zero(c) -> Column:
    """``replace_na(x, 0)`` on a double: NULL and NaN both become 0."""
    return F.coalesce(nan_to_null(c), F.lit(0.0))


# ------------------------------------------------------------------- sums


def server_sum(c) -> Column:
    """SQL ``SUM``: NULLs skipped, all-NULL group -> NULL."""
    return F.sum(_col(c))


def sum_or_zero(c) -> Column:
    """R ``sum(x, na.rm = TRUE)``: NULL/NaN skipped, empty -> 0."""
    return F.coalesce(F.sum(nan_to_null(c)), F.lit(0.0))


def strict_sum(c) -> Column:
    """R ``sum(x)`` without ``na.rm``: any NULL in the group -> NULL.

    ``count(x)`` skips NULLs and ``count(1)`` does not, so they differ exactly
    when the group holds a NULL.  Both are partial-aggregable, so the rule
    costs no extra shuffle.
    """
    c = _col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


# --------------------------------------------------------------- arithmetic


def ieee_div(n, d) -> Column:
    """``n / d`` with R/IEEE results for a zero divisor (T4).

    x/0 -> +Inf or -Inf by the sign of x, 0/0 and NaN/0 -> NaN, NULL stays
    NULL.  NaN is tested first because Spark orders NaN above every number.
    ANSI-mode ``/`` would raise on a zero divisor instead.
    """
    n, d = _col(n).cast("double"), _col(d).cast("double")
    at_zero = (
        F.when(F.isnan(n), F.lit(float("nan")))
        .when(n > 0, F.lit(float("inf")))
        .when(n < 0, F.lit(float("-inf")))
        .when(n.isNotNull(), F.lit(float("nan")))
    )
    return F.when(d == 0, at_zero).otherwise(F.try_divide(n, d))


def half_even(c, digits: int = 0) -> Column:
    """R ``round``: IEC 60559 round-half-to-even."""
    return F.bround(_col(c), digits)


_HEX = r"^\s*([+-]?)0[xX]([0-9a-fA-F]+)\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_int(c) -> Column:
    """R ``as.integer`` on text or numbers (T5).

    Parse as double, truncate toward zero, and give NULL for text that is not
    a number or values outside the 32-bit range: '12.7' -> 12, 'abc' -> NULL.
    The text must look like a number: a cast alone would take Java's type
    suffixes ('12d', '45F').  Whole hexadecimal texts count ('0x1A' -> 26).
    """
    text = _col(c).cast("string")
    digits = F.regexp_extract(text, _HEX, 2)
    hexadecimal = F.conv(digits, 16, 10).cast("double") * F.when(F.regexp_extract(text, _HEX, 1) == "-", -1).otherwise(1)
    d = F.when(text.rlike(_HEX), F.when(F.length(F.ltrim(digits, F.lit("0"))) <= 8, hexadecimal)).otherwise(_col(c).try_cast("double"))
    ok = (text.rlike(_NUMBER) | text.rlike(_HEX)) & ~F.isnan(d) & (d > F.lit(_INT_MIN_EXCLUSIVE)) & (d < F.lit(_INT_MAX_EXCLUSIVE))
    return F.when(ok, d.cast("int"))


def days_between(later, earlier) -> Column:
    """Whole days from ``earlier`` to ``later`` as a double (T6 decision)."""
    return F.datediff(F.to_date(_col(later)), F.to_date(_col(earlier))).cast("double")


# ------------------------------------------------------------------ strings


def norm_owner(c) -> Column:
    """``str_trim`` (both ends, Unicode white space), lower-case, then delete
    every space.  ``F.trim`` would strip only the space character."""
    c = _col(c)
    c = F.regexp_replace(c, r"(?U)^\s+", "")
    c = F.regexp_replace(c, r"(?U)\s+$", "")
    return F.regexp_replace(F.lower(c), " ", "")


def r_number_text(c) -> Column:
    """Number pasted into text the way R prints it: 63 not 63.0."""
    c = _col(c)
    whole = c.cast("double") == F.floor(c.cast("double"))
    return F.when(whole, c.cast("double").cast("bigint").cast("string")).otherwise(
        c.cast("string"))


def starts_with_ci(c, prefix: str) -> Column:
    """Case-insensitive prefix test (tidyselect ``starts_with`` default)."""
    return F.upper(_col(c)).startswith(prefix.upper())


def server_equals(c, literal: str, collation: str | None = None) -> Column:
    """String equality as the SQL server does it (T7): trailing blanks ignored.

    ``collation`` names a Spark collation that ignores them too, for servers
    whose collation also ignores case or accents: ``UTF8_LCASE_RTRIM``,
    ``UNICODE_CI_RTRIM``, ``UNICODE_CI_AI_RTRIM``...  Without one case counts."""
    if collation:
        return F.collate(_col(c), collation) == F.lit(literal)
    return F.rtrim(_col(c)) == F.lit(literal.rstrip(" "))


# --------------------------------------------------------------- label maps


def map_label(c, pairs: Sequence[tuple], default=None, *, server_side=False,
              collation: str | None = None) -> Column:
    """First-match code/label map as one CASE expression.

    ``default`` may be a literal or a Column (e.g. the input itself).  With
    ``server_side=True`` string keys compare as ``server_equals`` does.
    """
    c = _col(c)
    expr = None
    for key, label in pairs:
        cond = server_equals(c, key, collation) if (server_side and isinstance(key, str)) else (c == F.lit(key))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if default is None:
        return expr
    dflt = default if isinstance(default, Column) else F.lit(default)
    return dflt if expr is None else expr.otherwise(dflt)


# ------------------------------------------------------------------ seasons


def season_from_code(c, generation: str, config: ReportConfig = DEFAULT_CONFIG) -> Column:
    """SeasonID -> season year for one generation; unknown codes -> NULL."""
    pairs = sorted(config.season_codes[generation].items())
    return map_label(c, pairs).cast("int")


def season_codes(seasons: Iterable[int], generation: str,
                 config: ReportConfig = DEFAULT_CONFIG) -> list[int]:
    """Inverse of the code map: codes whose season is requested."""
    wanted = {int(s) for s in seasons}
    return sorted(code for code, season in config.season_codes[generation].items()
                  if season in wanted)


def season_code_filter(c, seasons: Iterable[int], generation: str,
                       config: ReportConfig = DEFAULT_CONFIG) -> Column:
    """``Season %in% seasons`` written on the raw code so it reaches the scan
    as ``In(SeasonID, ...)`` (a filter on the CASE expression would not)."""
    codes = season_codes(seasons, generation, config)
    return _col(c).isin(codes) if codes else F.lit(False)


def season_from_timestamp(c, config: ReportConfig = DEFAULT_CONFIG) -> Column:
    """Calendar year of a wall-clock timestamp, within the configured bands."""
    yr = F.year(_col(c))
    return F.when(yr.isin(sorted(int(y) for y in config.timestamp_seasons)), yr).cast("int")


def _ntz(year: int) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{year:04d}-01-01 00:00:00'")


def season_bands(seasons: Iterable[int],
                 config: ReportConfig = DEFAULT_CONFIG) -> list[tuple[int, int]]:
    """The requested timestamp seasons as half-open year bands ``[a, b)``,
    adjacent years merged."""
    years = sorted({int(s) for s in seasons} & set(config.timestamp_seasons))
    bands: list[tuple[int, int]] = []
    for y in years:
        if bands and bands[-1][1] == y:
            bands[-1] = (bands[-1][0], y + 1)
        else:
            bands.append((y, y + 1))
    return bands


def _in_bands(c, bands, bound) -> Column:
    c, cond = _col(c), None
    for a, b in bands:
        part = (c >= bound(a)) & (c < bound(b))
        cond = part if cond is None else (cond | part)
    return F.lit(False) if cond is None else cond


def timestamp_season_filter(c, seasons: Iterable[int],
                            config: ReportConfig = DEFAULT_CONFIG) -> Column:
    """``Season %in% seasons`` for timestamp bands, as OR-ed half-open ranges
    so Parquet receives the range predicates."""
    return _in_bands(c, season_bands(seasons, config), _ntz)


def year_season_filter(c, seasons: Iterable[int],
                       config: ReportConfig = DEFAULT_CONFIG) -> Column:
    """The same bands on a column of creation years (a partition column)."""
    return _in_bands(c, season_bands(seasons, config), F.lit)


def season_text_filter(c, seasons: Iterable[int]) -> Column:
    """``SeasonDesc %in% seasons`` where SeasonDesc is text."""
    return _col(c).isin([str(int(s)) for s in seasons])
