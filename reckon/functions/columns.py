"""Column-level helpers (all JVM-side built-ins, codegen friendly).

Blank handling: the source data treats ``''`` and missing as one concept.
We normalise to ``NULL`` at the source (``blank_to_null``) and keep
``is_blank`` as a safety net for frames that were not normalised.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: ColumnOrName) -> Column:
    """Null or exactly ``''`` (no trimming). Never null itself."""
    c = _c(c)
    return c.isNull() | (c.cast("string") == F.lit(""))


def blank_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Replace ``''`` by NULL in the string columns (all, or ``cols``)."""
    wanted = set(cols) if cols is not None else None
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType) and (wanted is None or f.name in wanted):
            out.append(F.nullif(F.col(f.name), F.lit("")).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def key_concat(*cols: ColumnOrName, sep: str = "") -> Column:
    """Concatenated text key where blank parts count as empty text.

    ``sep=''`` reproduces a separator-less key (which can collide:
    "1"+"12" == "11"+"2"); pass a separator to avoid that.
    """
    return F.concat_ws(sep, *[_c(c).cast("string") for c in cols])


def concat_strict(*cols: ColumnOrName) -> Column:
    """SQL ``a + b`` on text: null when any part is null."""
    return F.concat(*[_c(c).cast("string") for c in cols])


def ci_eq(c: ColumnOrName, value: str) -> Column:
    """Case-insensitive equality; null input gives null (row dropped by filter)."""
    return F.lower(_c(c)) == F.lit(value.lower())


def ci_ne(c: ColumnOrName, value: str) -> Column:
    """Case-insensitive inequality; null input gives null (row dropped)."""
    return F.lower(_c(c)) != F.lit(value.lower())


#: Suffix of the lower-cased companion of a text column (``with_ci``).
CI = "__ci"


def with_ci(df: DataFrame, *cols: str) -> DataFrame:
    """Add the lower-cased companion of each text column, to be written with the table at ingest.
    A reader that compares it with a constant (``ci_where``) filters in the scan, by row-group
    statistics and dictionaries; ``lower(col) = ...`` never gets there."""
    return df.withColumns({f"{c}{CI}": F.lower(F.col(c).cast("string")) for c in cols})


def drop_ci(df: DataFrame) -> DataFrame:
    """Without the companions."""
    return df.drop(*[c for c in df.columns if c.endswith(CI) and c[: -len(CI)] in df.columns])


def ci_where(df: DataFrame, col: str, equals: str | list[str] | None = None, not_equals: str | None = None, starts: str | None = None) -> DataFrame:
    """Rows whose ``col`` equals (one of) ``equals``, differs from ``not_equals`` and begins with ``starts``,
    whatever the case; null is dropped, as by ``ci_eq`` and ``ci_ne``. The predicates stand on the
    column's companion where the table has one, else on ``lower(col)``: same rows, without pushdown."""
    c = F.col(f"{col}{CI}") if f"{col}{CI}" in df.columns else F.lower(F.col(col))
    if equals is not None:
        df = df.where(c.isin([v.lower() for v in equals]) if isinstance(equals, (list, tuple, set)) else c == F.lit(equals.lower()))
    if not_equals is not None:
        df = df.where(c != F.lit(not_equals.lower()))
    if starts is not None:
        df = df.where(c.startswith(starts.lower()))
    return df


def ci_like(c: ColumnOrName, pattern: str) -> Column:
    return _c(c).ilike(pattern)


def ci_not_like(c: ColumnOrName, pattern: str) -> Column:
    return ~_c(c).ilike(pattern)


def contains_lit(c: ColumnOrName, text: str, ignore_case: bool = False) -> Column:
    """Literal (not regex) substring test; null input gives false."""
    c = _c(c).cast("string")
    if ignore_case:
        hit = F.contains(F.lower(c), F.lit(text.lower()))
    else:
        hit = F.contains(c, F.lit(text))
    return F.coalesce(hit, F.lit(False))


def ne_null_safe(c: ColumnOrName, value) -> Column:
    """``c != value`` that is true when ``c`` is null."""
    return ~_c(c).eqNullSafe(F.lit(value) if not isinstance(value, Column) else value)


# Latest instant a nanosecond timestamp can hold; in some columns the source
# system read later dates as missing.
_MAX_NS_TS = "2262-04-11 23:47:16"


def safe_date(c: ColumnOrName, fmt: str | None = None, ns_range: bool = False) -> Column:
    """Lenient timestamp parse: bad text gives null instead of an error;
    with ``ns_range`` a date beyond the nanosecond range does too."""
    c = _c(c)
    parsed = F.try_to_timestamp(c.cast("string"), F.lit(fmt)) if fmt else F.try_to_timestamp(c.cast("string"))
    if ns_range:
        parsed = F.when(parsed <= F.lit(_MAX_NS_TS).cast("timestamp"), parsed)
    return parsed


def safe_num(c: ColumnOrName, to: str = "double") -> Column:
    """Lenient number parse: blank or bad text gives null."""
    return _c(c).try_cast(to)


def scale_by_decimals(c: ColumnOrName, decimals: ColumnOrName | int) -> Column:
    """Amount stored in minor units divided by ``10^decimals``."""
    d = F.lit(decimals) if isinstance(decimals, int) else _c(decimals)
    return _c(c) / F.pow(F.lit(10.0), d)


def clamped_diff(a: ColumnOrName, b: ColumnOrName, tol: float = 0.01) -> Column:
    """``a - b`` with every value below ``tol`` (negatives too) set to 0;
    null when either side is missing."""
    a, b = _c(a), _c(b)
    d = a - b
    return F.when(a.isNull() | b.isNull(), F.lit(None)).when(d < F.lit(tol), F.lit(0.0)).otherwise(d)


def pct_change(new: ColumnOrName, old: ColumnOrName) -> Column:
    """``(new-old)/old*100``; null when old is 0 or either side is missing."""
    new, old = _c(new), _c(old)
    return F.when(old.isNotNull() & new.isNotNull() & (old != 0), (new - old) / old * F.lit(100.0))


def threshold_flag(pct: ColumnOrName, bound: float, above: bool = True) -> Column:
    """1/0 flag for ``pct > bound`` (or ``pct < bound``); null when pct is null."""
    pct = _c(pct)
    hit = pct > F.lit(bound) if above else pct < F.lit(bound)
    return F.when(pct.isNotNull(), hit.cast("int"))


def money(c: ColumnOrName, precision: int = 18, scale: int = 2) -> Column:
    """Exact money value for sums and equality tests."""
    return _c(c).cast(T.DecimalType(precision, scale))
