"""Token counts: pieces are counted once per distinct pre-token, joined to
the documents' pre-token frequencies, and summed; ids are never kept.

Each task turns its documents into blocks: the distinct pre-tokens of a
block, each with its (document, frequency) list. The lists stay with the block;
only the pre-tokens go, packed, to the owner of their hash, which counts the pieces
of each once and returns the counts in the order they came. The block joins
them to its lists and sums. A pre-token of every document costs its owner one
entry a block, however many documents hold it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.llm.bpe import word_bpe
from reckon.llm.common import BLOCK_DOCS, BLOCK_WORDS, Vocab, batch, doc_words, pack, packets, partitions, rows_of, runs, task_id, unpack
from reckon.session import cut_lineage

#: ``owner`` of the rows that stay with their block: its documents, and the lists of the pre-tokens sent to owner o (``KEPT_LIST`` - o).
KEPT_TABLE, KEPT_LIST = -1, -2

_ROW = pa.schema([("owner", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``), one row per input row.

    A null text counts as empty: 0 bytes, 0 tokens. Null ids and repeated
    rows are kept, each with its count. An empty table gives no rows.
    Special strings in a text count one token each. Texts are counted whole.
    """
    spark = docs.sparkSession
    owners = partitions(spark)

    def blocks(batches):
        bpe, n_block = word_bpe(tokenizer_path), 0
        vocab, ids, sizes, special, word, doc, held = Vocab(), [], [], [], [], [], 0

        def flush():
            nonlocal n_block, vocab, ids, sizes, special, word, doc, held
            block = (task_id() << 24) + n_block
            n_block += 1
            no_id = np.array([i is None for i in ids], np.uint8)
            table = pack(np.array([i or 0 for i in ids], np.int64), no_id, np.array(sizes, np.int64), np.array(special, np.int64))
            out = [(KEPT_TABLE, block, table)]
            if held:
                w, d, n = doc_words(np.repeat(np.arange(len(doc)), doc), np.concatenate(word), len(vocab))
                names = list(vocab)
                start = runs(w)
                owner = np.fromiter((zlib.crc32(x.encode("utf-8", "surrogatepass")) % owners for x in names), np.int32, len(names))
                for o, (mine,) in packets(owner, np.arange(len(names))):
                    length = start[mine + 1] - start[mine]
                    at = np.repeat(start[mine] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
                    text = "\n".join(names[i] for i in mine).encode("utf-8", "surrogatepass")
                    out.append((o, block, pack(text)))
                    out.append((KEPT_LIST - o, block, pack(length.astype(np.uint32), d[at], n[at])))
            vocab, ids, sizes, special, word, doc, held = Vocab(), [], [], [], [], [], 0
            return batch(_ROW, *zip(*out))

        for i, raw in rows_of(batches, "id", "text"):
            got, n_special = bpe.pre_tokens(raw.decode("utf-8", "replace"))
            ids.append(i)
            sizes.append(len(raw))
            special.append(n_special)
            word.append(vocab.ids(got))
            doc.append(len(got))
            held += len(got)
            if held >= BLOCK_WORDS or len(ids) >= BLOCK_DOCS:
                yield flush()
        if ids:
            yield flush()

    def owned(rows: pa.Table) -> pa.Table:
        """Pieces of the owner's distinct pre-tokens, once each, returned to every block that asked."""
        bpe, parts, vocab = word_bpe(tokenizer_path), [], Vocab()
        for block, payload in zip(rows.column("block").to_pylist(), rows.column("payload").to_pylist()):
            parts.append((block, vocab.ids(unpack(payload)[0].decode("utf-8", "surrogatepass").split("\n")).astype(np.uint32)))
        pieces, owner = bpe.counts(list(vocab)), rows.column("owner")[0].as_py()
        out = [(owner, block, pack(pieces[word].astype(np.uint32))) for block, word in parts]
        return pa.Table.from_batches([batch(_ROW, *zip(*out))], _ROW)

    def summed(rows: pa.Table) -> pa.Table:
        """Documents of one block: its lists, joined to the piece counts that the owners returned."""
        got = dict(zip(rows.column("owner").to_pylist(), rows.column("payload").to_pylist()))
        ids, no_id, sizes, total = unpack(got[KEPT_TABLE])
        total = total.copy()
        for o in (x for x in got if x >= 0):
            (pieces,), (length, d, n) = unpack(got[o]), unpack(got[KEPT_LIST - o])
            total += np.bincount(d, weights=np.repeat(pieces, length) * n.astype(np.float64), minlength=len(total)).astype(np.int64)
        return pa.Table.from_arrays([pa.array(ids, mask=no_id.astype(bool)), pa.array(sizes), pa.array(total), pa.array(total > limit)], schema=_OUT)

    ddl = "owner int, block long, payload binary"
    dealt = cut_lineage(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(blocks, ddl))
    back = dealt.filter("owner >= 0").groupBy("owner").applyInArrow(owned, ddl)
    return back.unionByName(dealt.filter("owner < 0")).groupBy("block").applyInArrow(summed, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
