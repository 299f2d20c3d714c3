"""Order specs and skew-safe "first row under an ordering".

An order spec is a list of strings ``"col [asc|desc] [nulls first|last]"``.
``pick_first`` reduces each group to one row with ``min_by``/``max_by`` over
a struct sort key. That is an aggregate with a map-side partial step, so a
hot key holding a third of all rows is combined on every mapper instead of
being sorted in one task (which a ``row_number`` window would do).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class SortField:
    name: str
    desc: bool = False
    nulls_first: bool | None = None  # None: Spark default (asc first, desc last)

    @property
    def nf(self) -> bool:
        return (not self.desc) if self.nulls_first is None else self.nulls_first


def parse_order(order) -> list[SortField]:
    if order is None:
        return []
    if isinstance(order, (str, SortField)):
        order = [order]
    out = []
    for o in order:
        if isinstance(o, SortField):
            out.append(o)
            continue
        words = o.split()
        name, rest = words[0], [w.lower() for w in words[1:]]
        desc = "desc" in rest
        nulls = None
        if "nulls" in rest:
            nulls = rest[rest.index("nulls") + 1] == "first"
        out.append(SortField(name, desc, nulls))
    return out


def _negate(df: DataFrame, f: SortField) -> Column:
    dt = df.schema[f.name].dataType
    c = F.col(f.name)
    if isinstance(dt, T.NumericType):
        return -c
    if isinstance(dt, T.DateType):
        return -F.unix_date(c)
    if isinstance(dt, T.TimestampType):
        return -F.unix_micros(c)
    if isinstance(dt, T.TimestampNTZType):
        # wall-clock microseconds without a time zone (a cast to a zoned
        # timestamp could map two wall-clock times of a DST gap together)
        day_us = F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400_000_000)
        tod_us = (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * F.lit(1_000_000)
        sec_us = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
        return -(day_us + tod_us + sec_us)
    if isinstance(dt, T.BooleanType):
        return -c.cast("int")
    raise ValueError(f"cannot mix sort directions on column {f.name} of type {dt}")


def sort_key(df: DataFrame, order) -> tuple[Column, bool]:
    """Struct key and whether the *max* of it is the first row."""
    fields = parse_order(order)
    if not fields:
        raise ValueError("an order is required")
    use_max = sum(f.desc for f in fields) * 2 > len(fields)
    parts = []
    for f in fields:
        c = F.col(f.name)
        val = c if f.desc == use_max else _negate(df, f)
        # flag orders nulls: under max the bigger flag wins, under min the smaller.
        null_wins = f.nf
        null_flag = 1 if (null_wins == use_max) else 0
        parts.append(F.when(c.isNull(), F.lit(null_flag)).otherwise(F.lit(1 - null_flag)))
        parts.append(val)
    return F.struct(*parts), use_max


def pick_first(df: DataFrame, keys: list[str], order, drop_null_keys: bool = True) -> DataFrame:
    """One row per ``keys``: the first under ``order`` (add a unique
    tie-break column to the order for a deterministic result)."""
    if drop_null_keys:
        cond = None
        for k in keys:
            cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
        df = df.where(cond)
    fields = parse_order(order)
    values = [c for c in df.columns if c not in keys]
    if len(fields) == 1 and values == [fields[0].name]:
        # Only the ordering column is carried: the first row's value is a
        # plain max/min (nulls first: null as soon as the group has one),
        # a hash aggregate with no sort and no struct buffer.
        f = fields[0]
        c = F.col(f.name)
        best = F.max(c) if f.desc else F.min(c)
        if f.nf:
            best = F.when(F.count(F.lit(1)) > F.count(c), F.lit(None)).otherwise(best)
        return df.groupBy(*keys).agg(best.alias(f.name)).select(*df.columns)
    key, use_max = sort_key(df, order)
    payload = F.struct(*[F.col(c) for c in df.columns])
    agg = F.max_by(payload, key) if use_max else F.min_by(payload, key)
    return df.groupBy(*keys).agg(agg.alias("__row")).select("__row.*")
