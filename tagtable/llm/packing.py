"""Packing tokenised documents into sequences by bounded-space online best-fit.

A document is its token ids and one end id. Only documents longer than a sequence are cut, into full pieces and a last
one that may be shorter. Pieces are dealt to shards of about ``SHARD_TOKENS`` tokens by a hash of the row and its
position; each shard packs its pieces, longest first, with at most ``OPEN_BINS`` open sequences. Their free space is kept
as a bitset with one bit for each size: the lowest set bit at or above a piece's length is the best fit. Where none
fits a sequence is opened; if too many are open, the fullest closes first.

Tokenising works on distinct words: the tokenizer never joins text over white space, nor over a stop after a letter, so
each distinct part is encoded once while a worker remembers it, and its ids are gathered for every place it stands
at. Texts stay where they are read; only pieces (a few numbers each) are shuffled.

A null or empty text is the end id alone. A null doc_id is kept. Rows repeated in full are separate documents and are
placed separately. The number of a sequence tells shard and place but means nothing. Extra columns are ignored; an
empty table gives no pieces.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtable.llm.common import IS_SPACE, is_in, read_table, settle, slices, text_buffer, word_hashes

SEQUENCE, END_ID = 4096, 1
VOCABULARY = "word_bpe_49k.json"
SHARD_TOKENS, OPEN_BINS = 1 << 21, 256
CACHED_WORDS = 500_000
ENCODE_AT_ONCE = 20_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True
STOP = np.zeros(256, bool)
STOP[list(b".,;:!?")] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def parts(data: np.ndarray, off: np.ndarray):
    """Start and end byte of each part, and for each document the number of its first part. A part is a word or what a
    stop after a letter cuts off from it: the tokenizer never joins over either."""
    inside = np.append(~IS_SPACE[data], False)
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    if len(data):
        edge[1:-1] |= STOP[data[1:]] & LETTER[data[:-1]]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends, np.searchsorted(starts, off)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lowered, as the tokenizer does itself, but for words with a mark that a special token begins with."""
    low = LOWER[data]
    marks = np.flatnonzero(data == 0x3C)
    if len(marks):
        gaps = np.flatnonzero(IS_SPACE[data])
        at = np.searchsorted(gaps, marks)
        begin = np.where(at > 0, gaps[np.maximum(at - 1, 0)] if len(gaps) else 0, 0)
        end = np.where(at < len(gaps), gaps[np.minimum(at, len(gaps) - 1)] if len(gaps) else len(data), len(data))
        for x, y in set(zip(begin.tolist(), end.tolist())):
            low[x:y] = data[x:y]
    return low


class WordIds:
    """Token ids of words by their hash, as flat arrays. Where more than ``CACHED_WORDS`` are remembered, those met
    only once since the last time are forgotten (they are encoded again when they return)."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work; each thread would hold memory of its own
        from tokenizers import Tokenizer

        with open(vocabulary, encoding="utf-8") as f:
            self.tokenizer = Tokenizer.from_str(f.read())
        self._hold(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32))

    def _hold(self, keys, begin, n, uses, flat) -> None:
        self.keys, self.begin, self.n, self.uses, self.flat = keys, begin, n, uses, flat

    def look_up(self, keys: np.ndarray, word) -> tuple[np.ndarray, np.ndarray]:
        """Begin and number of ids in ``flat`` for sorted distinct keys; ``word(i)`` gives the text of the i-th."""
        new = np.flatnonzero(~is_in(keys, self.keys))
        if len(new):
            counts, ids = [], [self.flat]
            for a in range(0, len(new), ENCODE_AT_ONCE):  # the library's results are much larger than the ids
                words = [word(i) for i in new[a : a + ENCODE_AT_ONCE].tolist()]
                coded = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
                counts += map(len, coded)
                ids.append(np.fromiter((i for x in coded for i in x), np.uint32))
            n = np.array(counts, np.int64)
            begin, flat = len(self.flat) + np.cumsum(n) - n, np.concatenate(ids)
            at = np.searchsorted(self.keys, keys[new])
            self._hold(np.insert(self.keys, at, keys[new]), np.insert(self.begin, at, begin), np.insert(self.n, at, n), np.insert(self.uses, at, 0), flat)
        at = np.searchsorted(self.keys, keys)
        self.uses[at] += 1
        return self.begin[at], self.n[at]

    def forget(self) -> None:
        if len(self.keys) > CACHED_WORDS:
            keep = self.uses > 1
            n = self.n[keep]
            begin = np.cumsum(n) - n
            flat = self.flat[np.repeat(self.begin[keep] - begin, n) + np.arange(int(n.sum()))]
            self._hold(self.keys[keep], begin, n, np.zeros(len(n), np.int64), flat)


_ids_of: dict[str, WordIds] = {}  # a Python worker serves many tasks; words stay known between them


def word_ids(vocabulary: str) -> WordIds:
    if vocabulary not in _ids_of:
        _ids_of[vocabulary] = WordIds(vocabulary)
    return _ids_of[vocabulary]


def token_ids(texts, ids: WordIds):
    """For slices of documents: (first document, ids of all, edges between documents)."""
    data, off = text_buffer(texts)
    for i, j in slices(off):
        part, o = lowered(data[off[i] : off[j]]), off[i : j + 1] - off[i]
        starts, ends, first = parts(part, o)
        if not len(starts):
            yield i, np.zeros(0, np.uint32), np.zeros(j - i + 1, np.int64)
            continue
        keys, at, back = np.unique(word_hashes(part, starts, ends), return_index=True, return_inverse=True)
        raw, a, b = part.tobytes(), starts[at].tolist(), ends[at].tolist()
        begin, n = ids.look_up(keys, lambda k: raw[a[k] : b[k]].decode())
        m = n[back]
        edge = np.concatenate(([0], np.cumsum(m)))
        yield i, ids.flat[np.repeat(begin[back] - edge[:-1], m) + np.arange(edge[-1])], edge[first]
        ids.forget()


def _pieces(sequence: int, end_id: int, vocabulary: str):
    def cut(batches):
        ids = word_ids(vocabulary)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for i, flat, edge in token_ids(batch["text"], ids):
                for d in range(len(edge) - 1):
                    doc = np.concatenate([flat[edge[d] : edge[d + 1]], end]).astype("<u4")
                    for k, a in enumerate(range(0, len(doc), sequence)):
                        piece = doc[a : a + sequence]
                        for column, x in zip(rows, (i + d, k, a, len(piece), zlib.crc32(piece))):
                            column.append(x)
            yield pa.record_batch({"doc_id": batch["doc_id"].take(pa.array(rows[0], pa.int64())), "piece": pa.array(rows[1], pa.int32()),
                                   "start": pa.array(rows[2], pa.int64()), "length": pa.array(rows[3], pa.int64()), "ids_crc32": pa.array(rows[4], pa.int64())})
    return cut


def best_fit(lengths: list[int], sequence: int = SEQUENCE, open_bins: int = OPEN_BINS) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, in the order given."""
    free_bits, by_free, n_open, n_bins = 0, {}, 0, 0
    bins, offsets = [], []
    for length in lengths:
        fits = free_bits >> length
        if fits:
            free = (fits & -fits).bit_length() - 1 + length
            own = by_free[free].pop()
            if not by_free[free]:
                free_bits ^= 1 << free
            n_open -= 1
        else:
            free, own = sequence, n_bins
            n_bins += 1
        bins.append(own)
        offsets.append(sequence - free)
        free -= length
        if free:
            if n_open == open_bins:  # the fullest closes, the new one included
                fullest = (free_bits & -free_bits).bit_length() - 1
                if fullest >= free:
                    continue
                by_free[fullest].pop()
                if not by_free[fullest]:
                    free_bits ^= 1 << fullest
                n_open -= 1
            by_free.setdefault(free, []).append(own)
            free_bits |= 1 << free
            n_open += 1
    return bins, offsets


def pack_documents(docs: DataFrame, sequence: int = SEQUENCE, end_id: int = END_ID, vocabulary: str | None = None, open_bins: int = OPEN_BINS) -> DataFrame:
    cut = _pieces(sequence, end_id, vocabulary or public_tokenizers.path(VOCABULARY))
    pieces = settle(docs.select("doc_id", "text").mapInArrow(cut, PIECES))
    tokens = pieces.agg(F.sum("length")).first()[0] or 0
    shards = max(1, -(-tokens // SHARD_TOKENS))

    def place(key, table):
        order = np.argsort(-table["length"].to_numpy(), kind="stable")
        table = table.take(pa.array(order)).drop_columns(["shard"])
        bins, offsets = best_fit(table["length"].to_pylist(), sequence, open_bins)
        return table.append_column("sequence_id", pa.array(np.array(bins, np.int64) + (key[0].as_py() << 32))).append_column("offset", pa.array(offsets, pa.int64()))

    shard = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards)).cast("long")
    return pieces.withColumn("shard", shard).groupBy("shard").applyInArrow(place, PIECES + ", sequence_id long, offset long")


def op6(spark, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))
