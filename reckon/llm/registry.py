"""Registered queries of this subpackage, with production parameters, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reckon.llm import quality, secrets, toxicity
from reckon.llm.collocations import collocations
from reckon.llm.common import table
from reckon.llm.embedding_dedup import embedding_dedup
from reckon.llm.exact_dedup import exact_dedup
from reckon.llm.lm_score import lm_scores
from reckon.llm.mixing import mix_sources
from reckon.llm.ngram_join import ngram_jaccard_join
from reckon.llm.packing import pack_documents
from reckon.llm.token_alignment import alignment_counts
from reckon.llm.token_counts import token_counts
from reckon.llm.warc import warc_round_trip

TOKENIZER = "word_bpe_49k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=2048)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.secret_scan(docs, secrets.learn(docs))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity_scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=2, capacity=4096)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"), n=5, percent=75)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3, block_words=256)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=100, longest=5, best=2000)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_lm_scoring, op3_quality_classifier, op4_secret_scan, op5_toxicity, op6_embedding_dedup, op7_packing, op8_ngram_join, op9_exact_dedup, op10_mixing, op11_token_alignment, op12_collocations, op13_warc)
}

ORACLE: dict[str, str] = {}
ORACLE["op9_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
WINDOW w AS (PARTITION BY t)
"""

#: Base 32 of the 160 bits: five hex digits are four letters.
ORACLE["op13_warc"] = """
SELECT page_id, octet_length(encode(t)) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (((('0x' || substr(sha1(t), 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < max(page_id) OVER w THEN max(page_id) OVER w END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS t FROM pages)
WINDOW w AS (PARTITION BY t)
"""

ORACLE["op12_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
w AS (SELECT lang, piece, unnest(words) AS w1, generate_subscripts(words, 1) AS i FROM numbered),
totals AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
runs AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4, lead(w1, 4) OVER o AS w5 FROM w WINDOW o AS (PARTITION BY piece ORDER BY i)),
grams AS (
    SELECT lang, 1 AS size, w1 AS phrase FROM runs
    UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs WHERE w4 IS NOT NULL
    UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM runs WHERE w5 IS NOT NULL),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
parts AS (SELECT lang, size, phrase, f, string_split(phrase, ' ') AS words FROM f),
inside AS (
    SELECT DISTINCT s.lang, s.phrase
    FROM parts l, (SELECT unnest(range(0, 2)) AS skip) k, f s
    WHERE l.size > 2 AND s.lang = l.lang AND s.f = l.f AND s.phrase = array_to_string(l.words[1 + skip:l.size - 1 + skip], ' ')),
cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, t.n, k.k, (1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f) AS score
    FROM parts c, (SELECT unnest(range(1, 5)) AS k) k, f l, f r, totals t
    WHERE c.size > k.k AND l.lang = c.lang AND l.phrase = array_to_string(c.words[1:k.k], ' ')
      AND r.lang = c.lang AND r.phrase = array_to_string(c.words[k.k + 1:c.size], ' ') AND t.lang = c.lang
      AND NOT EXISTS (SELECT 1 FROM inside x WHERE x.lang = c.lang AND x.phrase = c.phrase)),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM least)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM placed WHERE rank <= 2000
"""
