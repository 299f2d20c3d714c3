"""Token alignment against a plain version over the tokenizer libraries."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from reckon.llm import token_alignment as ta
from reckon.llm.registry import op11_token_alignment

SF = "/root/testdata/sf0.001"
PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TEXTS = [
    "the quick brown fox", "", None, " ", "  two  leading and trailing  ", "\u2581own mark", "\u2581", "Ünïcode naïve café 😀👩\u200d👧 ﬁ \x00 end", "<|endoftext|> and <s>x</s> <unk> <0x41> </s>",
    "line\r\none\n\n\n\ttab", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "漢字かな交じり文 и русский текст", "don't stop 12,345.678!!", "the quick brown fox", "\u3042" * 50, "e\u0301 o\u0308",
]


def spelled():
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    letters, n = {}, 0
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            letters[chr(byte)] = byte
        else:
            letters[chr(256 + n)], n = byte, n + 1
    return (
        lambda t: [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids],
        lambda t: [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode()) for i in b.encode(t)],
    )


def brute(texts):
    """Groups, links and sums by plain loops."""
    side_a, side_b = spelled()
    all_groups, docs = [], Counter()
    for t in texts:
        a, b = (side_a(t), side_b(t)) if t else ([], [])
        want = b" " + (t or "").encode()
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            a = b = []
        groups, i, j, at_a, at_b = [], 0, 0, 0, 0
        while i < len(a):
            own = ([a[i][0]], [b[j][0]])
            at_a, at_b = at_a + len(a[i][1]), at_b + len(b[j][1])
            i, j = i + 1, j + 1
            while at_a != at_b:
                if at_a < at_b:
                    own[0].append(a[i][0])
                    at_a, i = at_a + len(a[i][1]), i + 1
                else:
                    own[1].append(b[j][0])
                    at_b, j = at_b + len(b[j][1]), j + 1
            groups.append(own)
        all_groups.append(groups)
        docs.update({(p, q) for x, y in groups for p in x for q in y})
    best = defaultdict(int)
    for (p, _), n in docs.items():
        best[p] = max(best[p], n)
    out = []
    for groups in all_groups:
        linked = [(p, q) for x, y in groups for p in x for q in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(linked), sum(docs[x] == best[x[0]] for x in linked), sum(docs[x] for x in linked), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out, all_groups


@pytest.fixture(scope="module")
def small(spark):
    """Nulls, empty and long texts, ties, repeated rows, extra columns with names the operator uses."""
    rows = [(None if k == 3 else k % 13, t, k, "x") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id int, text string, block int, pair string").repartition(3)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_brute_force(spark, small):
    want, _ = brute(TEXTS)
    assert rows(ta.alignment_counts(small, *PATHS)) == sorted([(None if k == 3 else k % 13, *w) for k, w in enumerate(want)], key=str)
    assert sum(w[0] == 0 for w in want) == 4  # null, empty, and the two with the mark
    assert ta.alignment_counts(small.limit(0), *PATHS).collect() == []


def test_query_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want, _ = brute([r.text for r in docs])
    assert rows(op11_token_alignment(spark, SF)) == sorted([(r.doc_id, *w) for r, w in zip(docs, want)], key=str)


def test_groups(spark, small):
    _, want = brute(TEXTS)
    by = {k: [r for r in ta.token_groups(small, *PATHS).collect() if r.doc_id == k] for k in (0, 7, 9)}
    for k, got in by.items():
        texts = [j for j in range(len(TEXTS)) if j != 3 and j % 13 == k]
        assert sorted([[(x.a, x.b) for x in r.groups] for r in got]) == sorted([[tuple(x) for x in want[j]] for j in texts])
        for r in got:
            assert [x.start for x in r.groups] == [0, *(x.end for x in r.groups)][:-1]
    assert max(x.end for x in by[9][0].groups) == len(TEXTS[9].encode()) + 1


def test_blocks_and_wide_groups(spark, small, monkeypatch):
    """Small blocks, parts and expansions change nothing; a group with more links than are expanded at once is whole."""
    tok, texts = ta.Tokenizers(*PATHS), [(t or "").encode() for t in TEXTS]
    whole = ta.align(texts, tok)
    key, times = ta.links(whole, tok.n_b)
    monkeypatch.setattr(ta, "LINKS", 3)
    again, times_again = ta.links(whole, tok.n_b)
    assert (key == again).all() and (times == times_again).all() and times.sum() == (whole.size_a * whole.size_b).sum()
    long = " ".join(f"some word{k}, don't  x{k}\n \u00a0y ¿qué? \u3000z" for k in range(3000))
    assert len(ta._CUT.split(long.encode())) > 5000
    (a, n_a), (b, n_b) = tok.encode([long.encode(), b""])
    assert a.tolist() == tok.a.encode(" " + long, add_special_tokens=False).ids and b.tolist() == tok.b.encode(long)
    assert n_a.tolist() == [len(a), 0] and n_b.tolist() == [len(b), 0]
    monkeypatch.setattr(ta, "KEPT", 1)
    assert all((x[0] == y).all() for x, y in zip(tok.encode([long.encode()]), (a, b)))


def test_cuts_change_no_ids():
    rng, tok = np.random.default_rng(1), ta.Tokenizers(*PATHS)
    letters = [*" \t\n\u00a0\u2003\u3000\u0085", *"abcXYZ019'.,;!?-", "'s", "'ll", *"éß漢か😀ﬁ\u0301\u200d²ª", *[" "] * 20]
    texts = ["".join(rng.choice(letters, 60)) for _ in range(400)]
    (a, n_a), (b, n_b) = tok.encode([t.encode() for t in texts])
    side_a, side_b = spelled()
    for ids, n, by in ((a, n_a, side_a), (b, n_b, side_b)):
        whole = [b"".join(x for _, x in side_a(t)) == b"".join(x for _, x in side_b(t)) == b" " + t.encode() for t in texts]
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [[i for i, _ in by(t)] if w else [] for t, w in zip(texts, whole)]
        assert 10 < sum(whole)


def test_overlaps_share_bytes():
    rng, tok = np.random.default_rng(0), ta.Tokenizers(*PATHS)
    x = ta.align([" ".join(rng.choice([t for t in TEXTS if t], 5)).replace("\u2581", "").encode() for _ in range(20)], tok)
    got = set(zip(*(o.tolist() for o in ta.overlaps(x.a, x.b))))
    want = {(i, j) for i in range(len(x.a.ids)) for j in np.flatnonzero((x.b.start < x.a.end[i]) & (x.b.end > x.a.start[i])).tolist()}
    assert got == want
