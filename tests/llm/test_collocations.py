"""Collocations against brute force and SQL; tiles, trees and ranks."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from reckon.llm import collocations as co
from reckon.llm.registry import ORACLE, op12_collocations

SF = "/root/testdata/sf0.001"


def brute_counts(rows, longest):
    f = Counter()
    for lang, text in rows:
        lang, raw = "und" if lang is None else lang, (text or "").encode().lower()
        for c in b".,;:!?\n\x0b\x0c\r":
            raw = raw.replace(bytes([c]), b"\n")
        for piece in raw.split(b"\n"):
            words = [w for w in piece.replace(b"\t", b" ").split(b" ") if w]
            for size in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    return f


def brute(rows, least, longest, best):
    f, n = brute_counts(rows, longest), Counter()
    for (lang, p), k in f.items():
        n[lang] += k * (len(p) == 1)
    f = {k: v for k, v in f.items() if v >= least}
    out = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or any(v >= a and len(q) > len(p) and k == lang and any(q[i : i + len(p)] == p for i in range(len(q))) for (k, q), v in f.items()):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, b" ".join(p), left, right))
    return sorted((lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for lang, x in out.items() for r, (s, a, p, left, right) in enumerate(sorted(x)[:best]))


@pytest.fixture(scope="module")
def texts():
    """Ties, repeated rows, a word with a third of all occurrences, phrases inside longer ones, null languages and texts."""
    rng = np.random.default_rng(5)
    words = ["the", *(f"w{k}" for k in range(12)), "New", "York", "É x", "\x00"]
    weights = np.array([12, *[1] * 12, 2, 2, 1, 1]) / 30
    rows = []
    for k in range(150):
        own = list(rng.choice(words, 40, p=weights / weights.sum()))
        own[7:12], own[20:22] = ["a B c d e"], ["New York"]
        rows.append((k, [None, "en", "fr"][k % 3], "".join(w + str(rng.choice([" ", "\t ", " ", ", ", "\n", ". "])) for w in own)))
    return rows + [(None, "en", None), (200, "de", ""), (201, "de", " .,; \t\n"), (3, rows[3][1], rows[3][2]), (3, rows[3][1], rows[3][2])]


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("best", [5, 2000])
def test_against_brute_force(spark, texts, best):
    docs = spark.createDataFrame([(*r, 1, "x") for r in texts], "doc_id long, lang string, text string, block int, word string").repartition(3)
    want = brute([r[1:] for r in texts], 9, 5, best)
    assert got(co.collocations(docs, least=9, best=best)) == want and len(want) > 10
    assert {len(r[2].split(" ")) for r in want} >= ({2, 5} if best > 5 else set())
    assert co.collocations(docs, least=10**6).collect() == [] and co.collocations(docs.limit(0)).collect() == []


def test_tree_of_packets(spark, texts, monkeypatch):
    """Ten blocks whose packets are added up three at a time, in two steps, and whose pairs come back in three parts."""
    monkeypatch.setattr(co, "FAN", 3)
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string").repartition(10)
    assert got(co.collocations(docs, least=9, longest=3)) == brute([r[1:] for r in texts], 9, 3, 2000)


def test_blocks_in_memory(texts, monkeypatch):
    """A small block ends within a partition; sequences keep every neighbouring pair, each once."""
    import pyarrow as pa

    rows = pa.RecordBatch.from_arrays([pa.array([r[1] or "und" for r in texts]), pa.array([r[2] for r in texts])], ["lang", "text"])
    for most in (50, 10**6):
        monkeypatch.setattr(co, "BLOCK", most)
        words, pairs, of = Counter(), Counter(), {}
        for b in co._words([rows]):
            for r in b.to_pylist():
                if r["payload"] is None:
                    words[r["lang"], r["word"]] += r["n"]
                    of[r["local"]] = (r["lang"], r["word"])
                else:
                    (seq,) = co.unpack(r["payload"])
                    sent = co._next(r["block"], seq, 3).to_pylist()
                    for p in sent[1:]:
                        code, n = co.unpack(p["payload"])
                        for c, k in zip(code.tolist(), n.tolist()):
                            pairs[of[c >> co.BITS][0], of[c >> co.BITS][1] + b" " + of[c & co.MASK][1]] += k
                    of = {}
        every = brute_counts([r[1:] for r in texts], 2)
        assert words == {(k, w[0]): n for (k, w), n in every.items() if len(w) == 1} and pairs == {(k, b" ".join(w)): n for (k, w), n in every.items() if len(w) == 2}


def test_tiles_in_memory(monkeypatch):
    rng = np.random.default_rng(0)
    code = (rng.zipf(1.3, 300_000) % 40_000 << co.BITS) | rng.zipf(1.3, 300_000) % 40_000
    want = Counter(code.tolist())
    sums, dense = Counter(), 0
    monkeypatch.setattr(co, "HELD", 1000)
    tiles = {}
    for part in np.array_split(code, 4):
        for tile, own, n in co.count_pairs(part, 7):
            assert (np.diff(own) > 0).all() and (co.tile_of(own, 7) == tile).all()
            tiles.setdefault(tile, co.Tile(tile)).add(own, n)
    for tile, t in tiles.items():
        dense += tile < co.DENSE**2
        own, n = t.total()
        sums.update(dict(zip(own.tolist(), n.tolist())))
    assert sums == want and 0 < dense < len(tiles)


def test_packets_in_memory():
    """Any numbers come back, and those of a sorted or a sequence's packet take few bytes."""
    rng = np.random.default_rng(1)
    pairs = np.unique((rng.integers(0, 300, 20_000) << co.BITS) | rng.integers(0, 1000, 20_000))
    seq = np.where(rng.random(20_000) < 0.3, -1, rng.integers(0, 200, 20_000))
    odd = [np.zeros(0, np.int64), np.array([-1]), np.array([5, 5, 6]), np.array([-1, 3, 7]), np.array([2**62 - 1]), np.array([2**40, 3, 2**33]), np.unique(rng.integers(0, 2**62, 1000))]
    for a in [pairs, seq, *odd]:
        data, back = co.unpack(co.pack(b"\n\x00", a))
        assert data == b"\n\x00" and back.dtype == np.int64 and back.tolist() == a.tolist()
    assert len(co.pack(pairs)) < 1.5 * len(pairs) and len(co.pack(seq)) < 0.95 * len(seq)


def test_words_travel_in_packets(spark, monkeypatch):
    """A block's distinct words are no rows of their own: neither what is written nor what is joined grows with
    the part of them that is frequent. Words and languages that hold separators of other formats stay apart."""
    written, cut = [], co.cut_lineage

    def counted(df):
        out = cut(df)
        if "block" in out.columns:
            written.append(out.count())
        return out

    monkeypatch.setattr(co, "cut_lineage", counted)
    rng = np.random.default_rng(2)
    words = [*(f"w{k}" for k in range(600)), '["', "\x00a", "\u2028", "é\x1f"]
    rows = [(str(rng.choice(["en", 'a"\n', "", "\x00"])), " ".join(rng.permutation(words))) for _ in range(40)]
    totals, levels = co.frequent_phrases(spark.createDataFrame(rows, "lang string, text string").repartition(4), least=3, longest=2)
    want = {(k, p[0].decode()): n for (k, p), n in brute_counts(rows, 1).items() if n >= 3}
    assert {(r.lang, r.phrase): r.f for r in levels[0].collect()} == want and len(want) > 1800
    assert dict(map(tuple, totals.collect())) == {k: len(words) * sum(r[0] == k for r in rows) for k, _ in rows}
    packets = 4 * co.BUCKETS * co.partitions(spark)  # of each block at most one a bucket
    assert written[0] <= packets + 4 * (4 + 1) and written[1] <= packets + len(want)


def test_ranks(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("x"), F.lit(1).alias("part"))
    out = {r.id: r.x for r in co.ranked(rows.select("x"), F.desc("x")).collect()}
    assert sorted(out) == list(range(5000)) and all(out[k] > out[k + 1] for k in range(4999))


def test_scores_beyond_64_bits(spark, monkeypatch):
    """Products of counts near 10^13 are exact."""
    n, a, left, right = 9_876_543_210_123, 123_456_789_012, 223_456_789_013, 323_456_789_017
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    level = spark.createDataFrame([(0, "en", "x y", a, 0, 1, [left, a], [right, a], "y")], "id long, lang string, phrase string, f long, left long, right long, head array<long>, tail array<long>, last string")
    monkeypatch.setattr(co, "frequent_phrases", lambda *_: (totals, [level, level]))
    assert got(co.collocations(totals)) == [("en", 1, "x y", a, left, right, n, 1000 * a * n // (left * right))]


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, sf):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert got(op12_collocations(spark, sf)) == sorted(duck.sql(ORACLE["op12_collocations"]).fetchall())
