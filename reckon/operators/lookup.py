"""Keyed lookups ("vlookup") and key-set joins.

``lookup`` left-joins a reference on (possibly differently named) keys and
takes some of its columns into the frame under new names:

* ``replace``   - take the reference value, null when unmatched;
* ``fill``      - only where the target is blank: ``coalesce(target, ref)``;
* ``overwrite`` - found values replace, unmatched keep: ``coalesce(ref, target)``.

Fan-out: ``on_multi='fanout'`` keeps every matching reference row (plain
left join); ``'first'`` reduces the reference to one row per key under
``order`` first, with a skew-safe partial aggregate.

Join strategy is left to Catalyst + AQE: the reference is broadcast when
its *measured* size is under ``spark.sql.autoBroadcastJoinThreshold``,
otherwise both sides are shuffled on the key (AQE splits skewed
partitions). ``broadcast=True`` is only for references whose size is
bounded by construction (code tables, a few hundred rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reckon.functions.columns import is_blank
from reckon.operators.hot import hot_left_join
from reckon.operators.ordering import parse_order, pick_first


def _pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, dict):
        return list(on.items())
    return [(k, k) for k in on]


def _take(take) -> list[tuple[str, str]]:
    if isinstance(take, str):
        return [(take, take)]
    if isinstance(take, dict):
        return list(take.items())
    return [(k, k) for k in take]


def _join_cond(left: DataFrame, right: DataFrame, pairs, null_safe: bool):
    cond = None
    for lk, rk in pairs:
        c = left[lk].eqNullSafe(right[rk]) if null_safe else left[lk] == right[rk]
        cond = c if cond is None else cond & c
    return cond


def lookup(
    df: DataFrame,
    ref: DataFrame,
    on,
    take,
    mode: str = "replace",
    on_multi: str = "fanout",
    order=None,
    broadcast: bool | None = None,
    null_safe: bool = False,
    hot: bool = False,
) -> DataFrame:
    """Left lookup of ``take`` columns from ``ref`` into ``df``. ``hot`` (with
    ``on_multi='first'``): hot keys are found by a sketch and joined in place (``operators.hot``)."""
    if mode not in ("replace", "fill", "overwrite"):
        raise ValueError(f"unknown mode {mode}")
    pairs = _pairs(on)
    takes = _take(take)
    need = [r for _, r in pairs] + [s for s, _ in takes]
    if on_multi == "first":
        need += [f.name for f in parse_order(order)]
    ref_sel = ref.select(*dict.fromkeys(need))
    if not null_safe:
        for _, rk in pairs:
            ref_sel = ref_sel.where(F.col(rk).isNotNull())
    if on_multi == "first":
        ref_sel = pick_first(ref_sel, [r for _, r in pairs], order, drop_null_keys=not null_safe)
    elif on_multi != "fanout":
        raise ValueError(f"unknown on_multi {on_multi}")
    rkeys = [f"__rk{i}" for i in range(len(pairs))]
    rvals = [f"__rv{i}" for i in range(len(takes))]
    r = ref_sel.select(
        *[F.col(rk).alias(a) for (_, rk), a in zip(pairs, rkeys)],
        *[F.col(s).alias(a) for (s, _), a in zip(takes, rvals)],
    )
    if broadcast:
        r = F.broadcast(r)
    if hot:
        if on_multi != "first" or null_safe:
            raise ValueError("hot keys need one reference row a key (on_multi='first') and no null keys")
        joined = hot_left_join(df, r, {lk: a for (lk, _), a in zip(pairs, rkeys)})
    else:
        joined = df.join(r, _join_cond(df, r, [(lk, a) for (lk, _), a in zip(pairs, rkeys)], null_safe), "left")
    existing = set(df.columns)
    out = []
    dsts = {d: a for (_, d), a in zip(takes, rvals)}
    for c in df.columns:
        if c in dsts:
            a = dsts[c]
            if mode == "replace":
                out.append(F.col(a).alias(c))
            elif mode == "fill":
                out.append(F.when(is_blank(F.col(c)), F.col(a)).otherwise(F.col(c)).alias(c))
            else:
                out.append(F.coalesce(F.col(a), F.col(c)).alias(c))
        else:
            out.append(joined[c] if hot else df[c])
    out += [F.col(a).alias(d) for d, a in dsts.items() if d not in existing]
    return joined.select(*out)


#: Bits of a sieve for each key, bits of one of its bitmaps, and keys from which on rows are not sieved (128 MB of bits).
SIEVE_BITS, MAP_BITS, SIEVE_KEYS = 16, 32768, 1 << 26


def sieved(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """The rows of ``df`` whose key is in ``keys``, and a few others (some 6 %): they are tested in place, against bitmaps of the
    hashes of the keys, so that a join that keeps few rows shuffles few. ``keys`` is read twice (count and bits): cut it before
    if it is dear. Keys whose types differ or do not compare by their bits, and more than ``SIEVE_KEYS``, sieve nothing."""
    pairs = _pairs(on)
    exact = (T.StringType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DateType)
    if any(df.schema[lk].dataType != keys.schema[rk].dataType or not isinstance(df.schema[lk].dataType, exact) for lk, rk in pairs):
        return df
    n = keys.count()
    if n > SIEVE_KEYS:
        return df
    size = max(1, -(-n * SIEVE_BITS // MAP_BITS)) * MAP_BITS
    bits = MAP_BITS.bit_length() - 1

    def place(cols: list[str]) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(size))

    held = keys.select(place([rk for _, rk in pairs]).alias("at"))
    maps = held.groupBy(F.shiftright("at", bits).alias("__map")).agg(F.bitmap_construct_agg(F.col("at") % MAP_BITS).alias("__bits"))
    at = place([lk for lk, _ in pairs])
    byte = F.conv(F.hex(F.substring("__bits", (F.shiftright(at % MAP_BITS, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    one = F.get(F.array(*[F.lit(1 << k) for k in range(8)]), (at % 8).cast("int"))
    # a semi-join: Catalyst pushes the semi-join that follows below an inner one
    return df.join(F.broadcast(maps), (F.shiftright(at, bits) == F.col("__map")) & (byte.bitwiseAND(one) != 0), "left_semi")


def semi_in(df: DataFrame, keys: DataFrame, on, sieve: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (SQL ``IN``/``EXISTS``).

    The key side is de-duplicated with a partial aggregate before the
    shuffle, so repeated or hot keys cost one row per mapper. ``sieve``: most
    rows have no such key and are left out before the shuffle (``sieved``)."""
    pairs = _pairs(on)
    if sieve:
        df = sieved(df, keys, on)
    alias = [f"__sk{i}" for i in range(len(pairs))]
    k = keys.select(*[F.col(r).alias(a) for (_, r), a in zip(pairs, alias)]).distinct()
    return df.join(k, _join_cond(df, k, [(l, a) for (l, _), a in zip(pairs, alias)], False), "left_semi")


def anti_not_in(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys`` (``NOT EXISTS``
    semantics: a null key on the left is kept)."""
    pairs = _pairs(on)
    alias = [f"__ak{i}" for i in range(len(pairs))]
    k = keys.select(*[F.col(r).alias(a) for (_, r), a in zip(pairs, alias)]).distinct()
    return df.join(k, _join_cond(df, k, [(l, a) for (l, _), a in zip(pairs, alias)], False), "left_anti")


def propagate_by_key(
    df: DataFrame,
    key: str,
    value: str,
    target: str,
    order,
    where=None,
    pick: str = "first",
    mode: str = "fill",
    hot: bool = False,
) -> DataFrame:
    """Write the value found on a subset of rows to every row sharing its key.

    ``where`` selects the rows that carry a value (rows with a blank value
    never do); among several, the first (or last) under ``order`` wins."""
    src = df.where(~is_blank(F.col(value)))
    if where is not None:
        src = src.where(where)
    fields = parse_order(order)
    if pick == "last":
        from reckon.operators.ordering import SortField

        fields = [SortField(f.name, not f.desc, not f.nf) for f in fields]
    cols = list(dict.fromkeys([key, value] + [f.name for f in fields]))
    one = pick_first(src.select(*cols), [key], fields)
    return lookup(df, one, on={key: key}, take={value: target}, mode=mode, on_multi="first" if hot else "fanout", order=fields if hot else None, hot=hot)
