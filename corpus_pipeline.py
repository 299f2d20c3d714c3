"""A training-data pipeline over ``documents``: quality filter, exact and near
duplicates, source mix, packed sequences.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of
``docs``; each works on what its predecessor kept. Between stages ``run`` writes
Parquet into the shared checkpoint folder and reads it again. An empty table
passes through; null texts count as empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reckon.llm import quality
from reckon.llm.common import ship_code, table
from reckon.llm.exact_dedup import exact_dedup
from reckon.llm.mixing import WORD, mixed_blocks
from reckon.llm.ngram_join import ngram_jaccard_join
from reckon.llm.packing import pack_documents
from reckon.session import cut_lineage


#: File names that are broadcast at most.
MOST_FILES = 100_000


def _key() -> Column:
    """The id as a join key that is never null."""
    return F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))


def _own(docs: DataFrame, *names: str) -> list[str]:
    """Column names that ``docs`` does not have (in any case of letters), from ``names``."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def _numbered(docs: DataFrame, row: str) -> DataFrame:
    """``docs`` with ``row``: file and place of the row in the Parquet that ``docs`` reads, the same at
    each reading. What is not read from files is written first."""
    file, n, place = _own(docs, "_file", "_n", "_place")
    try:
        at = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place))
    except AnalysisException:
        return _numbered(cut_lineage(docs), row)
    files = at.select(file).distinct().withColumn(n, F.row_number().over(Window.orderBy(file)).cast("long"))
    few = files.count() <= MOST_FILES  # broadcast up to some 20 MB, else joined by shuffle
    return at.join(F.broadcast(files) if few else files, file).select(*docs.columns, (F.shiftleft(n, 40) + F.col(place)).alias(row))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the classifier, learned from the labels of ``docs``, does not reject."""
    ship_code(spark)
    return quality.keep_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest id; one row of repeated rows."""
    ship_code(spark)
    key, sha, n = _own(docs, "_key", "_sha", "_n")
    stay = exact_dedup(docs).filter("kept").select(_key().alias(key), F.col("text_sha256").alias(sha)).distinct()
    low = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    met = docs.withColumn(key, _key()).withColumn(sha, F.sha2(low, 256)).join(stay, [key, sha], "left_semi")
    return met.withColumn(n, F.row_number().over(Window.partitionBy(key, sha).orderBy(key))).filter(F.col(n) == 1).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id (null last). Rows are compared and
    dropped one by one: others of the same id, or without an id, are not touched by it."""
    ship_code(spark)
    row, least = _own(docs, "_row", "_least")
    rows = _numbered(docs, row)
    far = cut_lineage(ngram_jaccard_join(rows, id_col=row).filter("doc_id != component_id").select(F.col("doc_id").alias(row), F.col("component_id").alias(least)))
    group = far.union(far.select(least, least).distinct())
    first = group.join(rows.select(row, "doc_id"), row).groupBy(least).agg(F.min_by(row, F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias(row))
    return rows.join(group.join(first.select(row), row, "left_anti"), row, "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix reads: for each row and epoch the runs of words in the blocks that it takes, so that
    each source gives its target. A run that is the whole document has its text as it is;
    another run, its words and the white space after each. Documents that the mix does not read go."""
    ship_code(spark)
    row, run = _own(docs, "_row", "_run")
    rows = _numbered(docs, row)
    pieces, _ = mixed_blocks(rows, row_col=row)
    order = Window.partitionBy("row", "epoch").orderBy("from")
    after = F.lag(F.col("from") + F.col("words")).over(order)
    runs = pieces.withColumn("new", F.when(after == F.col("from"), 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    runs = runs.groupBy("row", "epoch", "run").agg(F.min("from").alias("from"), F.sum("words").alias("words"), F.first("size").alias("size"))
    runs = runs.select(F.col("row").alias(row), F.struct("from", "words", "size").alias(run))
    space = WORD.replace("[^", "[").replace("+", "*")
    words = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"({WORD}{space})"), F.lit(1))
    read = F.array_join(F.slice(words, (F.col(f"{run}.from") + 1).cast("int"), F.col(f"{run}.words").cast("int")), "")
    text = F.when(F.col(f"{run}.words") == F.col(f"{run}.size"), F.col("text")).otherwise(read)
    return rows.join(runs, row).withColumn("text", text).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences of at most 4096 tokens. Fewer texts are
    tokenised at a time and fewer ids kept, as the executors' heaps have grown in the earlier stages."""
    ship_code(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096, at_once=1_000_000, cached=(200_000, 60_000))


STAGES = [("quality", quality_filter), ("exact_dedup", drop_copies), ("ngram_join", drop_near_copies), ("mixing", mix), ("packing", pack)]

#: The classifier and the similarity join have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
