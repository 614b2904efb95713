"""Packing token sequences: first-fit decreasing in random groups of documents.

A document's ids (its text's byte-level BPE ids and one end id) are cut into
pieces of the sequence length and a rest. Random groups of bounded expected
size are packed independently: pieces, largest first, go to the first
sequence with room, found in a tournament tree of remaining capacities in
logarithmic time. One pass over the texts, one narrow shuffle of pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamelake.llm import blocks
from gamelake.llm.tables import small_batches

LENGTH = 2048
END_ID = 1
#: Expected documents of a group. Groups are drawn row by row, so no key can fill one.
GROUP_DOCS = 4000
#: Distinct words whose ids a worker keeps.
CACHE_WORDS = 2_000_000

#: White space (beyond the ASCII word separators) at which the tokenizer may split differently.
_WIDE_SPACE = "[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

_PIECES = pa.schema([("group", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
_DDL = "group long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordIds:
    """Ids of whole texts, from the tokenizer's ids of their distinct words.

    The tokenizer's pattern never joins a word (with the one space before it)
    with what stands beside it, so each distinct word is encoded once by the
    tokenizer and its ids are put together per text. Texts with white space
    beyond ASCII are encoded whole.

    ``added``: the tokenizer's added tokens (<|endoftext|>) are found in texts,
    as it does by default, and texts that hold one are encoded whole; otherwise
    they are read as plain text.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        contents = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.added = [c.encode("utf-8") for c in contents if c]
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.begin = np.zeros(1, np.int64)  # of each known word's ids in flat
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Encode new words; ``keys`` are sorted and not known yet."""
        new = self._encode(words)
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        known = len(self.begin) - 1
        self.flat = np.concatenate([self.flat, np.fromiter((i for w in new for i in w), np.uint32, int(sizes.sum()))])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.place = np.insert(self.place, at, known + np.arange(len(keys)))

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def block(self, block: blocks.Block) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids)."""
        buf, offs = block.buf, block.offs
        if len(buf) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(block) + 1, np.int64)
        space = blocks.WORD_SPACE[buf]
        starts, ends = block.runs(~space)
        # A word takes the one space before it.
        inner = starts > 0
        inner &= ~blocks.among(starts, offs)
        takes = inner & (buf[np.maximum(starts - 1, 0)] == 32)
        space[starts[takes] - 1] = False
        starts = starts - takes
        gap_s, gap_e = block.runs(space)
        # What is left of white space before a word that does not begin with its last space splits off that last character.
        before_word = blocks.among(gap_e, starts) & (buf[np.minimum(gap_e, len(buf) - 1)] != 32) & ~blocks.among(gap_e, offs)
        split = before_word & (gap_e - gap_s > 1)
        tail = gap_e[split] - 1
        gap_e = gap_e.copy()
        gap_e[split] -= 1
        s = np.concatenate([starts, gap_s, tail])
        e = np.concatenate([ends, gap_e, tail + 1])
        order = np.argsort(s, kind="stable")
        s, e = s[order], e[order]
        key = block.hashes(s, e)
        distinct, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        new = ~blocks.among(distinct, self.keys)
        if len(self.keys) + np.count_nonzero(new) > CACHE_WORDS:
            self._clear()
            new[:] = True
        if new.any():
            raw = buf.tobytes()
            self._learn(distinct[new], [raw[s[i]:e[i]].decode("utf-8") for i in first[new].tolist()])
        at = np.searchsorted(self.keys, distinct)
        word = self.place[at][inverse]
        lo, n = self.begin[word], self.begin[word + 1] - self.begin[word]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.arange(total[-1]) - np.repeat(total[:-1] - lo, n)]
        return ids, total[np.searchsorted(s, offs)]


_ENCODERS: dict[tuple[str, bool], WordIds] = {}


def _encoder(path: str, added: bool) -> WordIds:
    if (path, added) not in _ENCODERS:
        _ENCODERS[path, added] = WordIds(path, added)
    return _ENCODERS[path, added]


def token_rows(column: pa.Array, path: str, added: bool = False):
    """(row, ids with the end id) for each text of a string column, in order."""
    import re

    wide = re.compile(_WIDE_SPACE)
    encoder = _encoder(path, added)
    end = np.asarray([END_ID], dtype="<u4")
    for block in blocks.text_blocks(column, max_bytes=4 << 20):
        ids, offs = encoder.block(block)
        plain = block.buf.size == 0 or not ((block.buf == 0xC2) | (block.buf == 0xE1) | (block.buf == 0xE2) | (block.buf == 0xE3)).any()
        raw = block.buf.tobytes() if encoder.added else b""
        marks = [c for c in encoder.added if c in raw]
        for d in range(len(block)):
            own = ids[offs[d]: offs[d + 1]]
            if marks or not plain:
                text = block.buf[block.offs[d]: block.offs[d + 1]].tobytes()
                if any(c in text for c in marks) or wide.search(text.decode("utf-8")):
                    own = np.asarray(encoder._encode([text.decode("utf-8")])[0], dtype=np.uint32)
            yield block.lo + d, np.concatenate([own.astype("<u4", copy=False), end])


def _pieces(path: str, groups: int, added: bool):
    def run(batches):
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column(0)
            out: list[list] = [[] for _ in _PIECES]
            for i, tokens in token_rows(batch.column(1), path, added):
                doc = ids[i].as_py()
                draw = np.asarray([(task << 32) + row], dtype=np.uint64)
                group = int(blocks.mix64(blocks.mix64(draw) + np.uint64((doc or 0) & 0xFFFFFFFFFFFFFFFF))[0] % np.uint64(groups))
                row += 1
                for start in range(0, len(tokens), LENGTH):
                    part = tokens[start: start + LENGTH]
                    for col, value in zip(out, (group, doc, start, len(part), zlib.crc32(part.tobytes()), len(tokens))):
                        col.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=_PIECES)

    return run


def first_fit_decreasing(lengths: np.ndarray, capacity: int = LENGTH) -> np.ndarray:
    """Bin of each length (given in decreasing order): the first bin with room.

    ``tree`` is a tournament of remaining capacities: node i holds the larger
    of nodes 2i and 2i + 1, the leaves are the bins in order of opening.
    """
    leaves = 1 << max(0, (len(lengths) - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins = np.zeros(len(lengths), dtype=np.int64)
    for k, size in enumerate(lengths.tolist()):
        i = 1
        while i < leaves:
            i *= 2
            if tree[i] < size:
                i += 1
        bins[k] = i - leaves
        tree[i] -= size
        while i > 1:
            i //= 2
            best = tree[2 * i]
            if tree[2 * i + 1] > best:
                best = tree[2 * i + 1]
            if tree[i] == best:
                break
            tree[i] = best
    return bins


def _pack_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
    rows["sequence_id"] = (np.int64(key[0]) << 32) + first_fit_decreasing(rows["length"].to_numpy())
    rows["offset"] = rows.groupby("sequence_id")["length"].cumsum() - rows["length"]
    return rows.drop(columns="group")


def pack(docs: DataFrame, vocabulary: str, group_docs: int = GROUP_DOCS, added: bool = False) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``vocabulary``: path of the tokenizer's file on every machine; ``added``:
    whether its added tokens are found in texts, as by default in the tokenizer,
    or are plain text there. Each id of
    each row's text lies in exactly one piece; ids_crc32 is over its ids as
    little-endian unsigned 32-bit numbers. Pieces of a sequence fill it from
    offset 0 without gaps, ``LENGTH`` at most. Null and empty texts are the
    end id alone. A null doc_id is carried; repeated rows are packed each.
    An empty table gives no pieces. Extra columns are ignored.

    A group's pieces meet in one task: ``group_docs`` documents are expected
    in each, drawn at random per row, whatever the source or id.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    groups = max(1, -(-docs.count() // group_docs))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = text.mapInArrow(_pieces(vocabulary, groups, added), _DDL)
    return cut.groupBy("group").applyInPandas(
        _pack_group, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
