"""Mixing sources to target weights, in DataFrame functions only.

Words of a source, its documents laid end to end in a fixed order, are cut
into blocks of ``block_words``. A source whose target is t words gets
t / block_words slots. All slots are shuffled over the output shards by one
keyed permutation of their numbers, so the source counts of a shard are a
multinomial draw without replacement and add up to the targets. The k-th
slot of a source reads block perm(k mod blocks), with another permutation for
each epoch. Slots and blocks meet in a join on (source, block); the mix is the
table of the pieces that they read, by shard and position, and all counts are sums over it.

Permutations are swap-or-not shuffles: for each round a pair x, K - x (mod n)
is swapped when a keyed bit of its larger member is set; any n, no tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reckon.llm.common import partitions
from reckon.session import cut_lineage

#: Fixed values of the permutations: rounds, and the prime and factors of the keyed bits.
ROUNDS, PRIME = 12, 2147483647
KEY_A, KEY_B, BIT_A, BIT_B = 1103515245, 12345, 69069, 1013904223

WORD = "[^\\x20\\x09-\\x0D]+"
CHUNK_SLOTS, BUCKET_DOCS, MAX_BUCKETS = 8192, 1024, 1 << 20


def permute(x: Column, n: Column, key: Column) -> Column:
    """A keyed permutation of 0..n-1 applied to x."""
    p = F.lit(PRIME).cast("long")

    def swap(at: Column, r: Column) -> Column:
        k = F.pmod(F.pmod((key + r) * F.lit(KEY_A) + r * F.lit(KEY_B), p) * (r + F.lit(7)), n)
        other = F.pmod(k + n - at, n)
        bit = F.pmod(F.pmod(F.greatest(at, other), p) * F.pmod(F.lit(BIT_A) * (key + r), p) + r * F.lit(BIT_B), p)
        return F.when(F.pmod(F.shiftright(bit, 5), F.lit(2)) == 1, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1).cast("long"), F.lit(ROUNDS).cast("long")), x, swap)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """source, s (rank by code point, null last), source_size, target of each
    source of ``sizes`` (source, size). A source is full when its ``most``-fold size
    is below its share of what the sources with smaller size per weight leave."""
    by = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by = by.withColumn("s", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).cast("long"))
    by = by.withColumn("w", F.array(*map(F.lit, weights))[F.pmod("s", F.lit(len(weights))).cast("int")].cast("long")).withColumn("top", F.col("source_size") * most)
    order = Window.orderBy(F.col("top") / F.col("w"), "s")
    whole = Window.partitionBy()
    by = by.withColumn("total", F.sum("source_size").over(whole))
    by = by.withColumn("left", F.col("total") - (F.sum("top").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("top")))
    by = by.withColumn("w_left", F.sum("w").over(whole) - F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("w"))
    by = by.withColumn("full", F.col("top").cast("decimal(38,0)") * F.col("w_left") <= F.col("w").cast("decimal(38,0)") * F.col("left"))
    rest = F.sum(F.when(~F.col("full"), F.col("w"))).over(whole)
    spare = F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("top"))).over(whole), F.lit(0))
    return by.select("source", "s", "source_size", F.when(F.col("full"), F.col("top").cast("double")).otherwise(F.col("w") * spare / rest).alias("target"))


def slots(targets: DataFrame, block_words: int, shard_slots: int = 4096) -> DataFrame:
    """s, block, words (to read from the block's start), epoch, shard, position: the mix, block by block."""
    t = targets.filter("source_size > 0").withColumn("words", F.floor(F.col("target") + 0.5).cast("long")).filter("words > 0")
    b = F.lit(block_words).cast("long")
    t = t.withColumn("blocks", F.ceil(F.col("source_size") / b).cast("long"))
    t = t.withColumn("whole", F.expr(f"source_size div {block_words}"))  # a short last block comes last in each epoch
    t = t.withColumn("epochs", F.expr("words div source_size")).withColumn("rest", F.col("words") - F.col("epochs") * F.col("source_size"))
    t = t.withColumn("n", F.col("epochs") * F.col("blocks") + F.ceil(F.col("rest") / b).cast("long"))
    t = t.withColumn("before", F.sum("n").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).withColumn("all", F.sum("n").over(Window.partitionBy()))
    t = t.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (n - 1) div {CHUNK_SLOTS})"))).repartition(partitions(targets.sparkSession), "s", "chunk")
    t = t.withColumn("k", F.explode(F.expr(f"sequence(chunk * {CHUNK_SLOTS}L, least(n, (chunk + 1) * {CHUNK_SLOTS}L) - 1)")))
    t = t.withColumn("epoch", F.expr("k div blocks")).withColumn("step", F.pmod("k", "blocks"))
    last = (F.col("epoch") == F.col("epochs")) & ((F.col("step") + 1) * b > F.col("rest"))
    at = permute(F.col("before") + F.col("k"), F.col("all"), F.lit(1).cast("long"))
    return t.select(
        "s",
        F.when(F.col("step") < F.col("whole"), permute(F.col("step"), F.greatest(F.col("whole"), F.lit(1)), F.col("s") * 64 + F.col("epoch") * 16 + 2)).otherwise(F.col("step")).alias("block"),
        F.when(last, F.col("rest") - F.col("step") * b).otherwise(b).alias("words"),
        "epoch",
        F.floor(at / shard_slots).cast("long").alias("shard"),
        F.pmod(at, F.lit(shard_slots)).alias("position"),
    )


def mixed_blocks(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, block_words: int = 256, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The mix, and the rows it is made of; both are written tables.

    The mix has shard, position, s, epoch, block, row, size, from, words: the piece of ``words`` words
    that a slot reads of a row of ``size`` words, from the row's word ``from`` on. A shard's slots, and so its
    sources, are drawn without replacement. The rows are row (``row_col``, else a number), doc_id,
    source, s, size, source_size, target, at (the row's first word in its source).
    """
    row = [F.col(row_col).cast("long").alias("row")] if row_col else []
    sizes = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORD)).cast("long").alias("size"), F.xxhash64(F.col(text_col).cast("string")).alias("mark"), *row)
    sizes = cut_lineage(sizes)
    sizes = sizes if row_col else sizes.withColumn("row", F.monotonically_increasing_id())
    targets = cut_lineage(source_targets(sizes, weights, most))
    buckets = min(MAX_BUCKETS, max(1, sizes.count() // BUCKET_DOCS))

    # Each document's first word in its source: sums before its bucket, then before it in the bucket. The bucket is a hash
    # of id and text, so that ids in steps, null ids and repeated ids spread, whatever file they come from; rows without words take no place.
    sizes = sizes.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    sizes = sizes.withColumn("bucket", F.pmod(F.when(F.col("size") > 0, F.xxhash64("doc_id", "mark")).otherwise(F.xxhash64("row")), F.lit(buckets)))
    per = sizes.groupBy("s", "bucket").agg(F.sum("size").alias("held"))
    per = per.select("s", "bucket", (F.sum("held").over(Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("held")).alias("base"))
    inner = Window.partitionBy("s", "bucket").orderBy(F.col("doc_id").asc_nulls_last(), "size", "mark", "row").rowsBetween(Window.unboundedPreceding, 0)
    placed = sizes.withColumn("before", F.sum("size").over(inner) - F.col("size")).join(per, ["s", "bucket"]).withColumn("at", F.col("base") + F.col("before"))
    placed = cut_lineage(placed.select("row", "doc_id", "source", "s", "size", "source_size", "target", "at"))

    parts = placed.filter("size > 0").select("row", "s", "size", "at", F.explode(F.expr(f"sequence(at div {block_words}, (at + size - 1) div {block_words})")).alias("block"))
    start = F.col("block") * block_words
    parts = parts.select("row", "s", "size", "block", F.greatest(F.lit(0), F.col("at") - start).alias("lo"), F.least(F.lit(block_words), F.col("at") + F.col("size") - start).alias("hi"), (start - F.col("at")).alias("shift"))
    # The slots grow with the words, which the planner cannot see in the few targets: no broadcast.
    met = parts.join(slots(targets, block_words).hint("merge"), ["s", "block"])
    read = F.least("hi", "words") - F.col("lo")
    mix = met.filter(read > 0).select("shard", "position", "s", "epoch", "block", "row", "size", (F.col("lo") + F.col("shift")).alias("from"), read.cast("long").alias("words"))
    return cut_lineage(mix), placed


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, block_words: int = 256, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken, one row per input row.

    Size is the number of words (null text: 0). Sources by code point, null
    last, weigh ``weights`` in turn and share the total of all sizes; a target
    stops at ``most`` times its source's size and the excess is shared again.
    ``taken`` counts the words that the mix (``mixed_blocks``) reads from the document, repeats
    included: a source's sum is its target, rounded, and no document gives more than
    ``most`` times the size. Equal inputs give equal mixes; a source's
    documents are ordered by a bucket of id and text, then id, size and text, so
    that the order of files and rows decides nothing but which of equal rows is which. Null
    ids and repeated rows are mixed like any others; an empty table gives no rows.
    """
    mix, placed = mixed_blocks(docs, weights, most, block_words, id_col, text_col, source_col)
    taken = mix.groupBy("row").agg(F.sum("words").alias("taken"))
    out = placed.join(taken, "row", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
