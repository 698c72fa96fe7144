"""Language-model scoring: add-one word unigrams and the marginal probability of a subword lattice.

Tokens are words (runs of non-space bytes, A-Z lowered) and one end for each text. The base score is the add-one
unigram log10 probability with counts from the training documents. The model's score replaces each word's probability
by the sum over all its segmentations into pieces of an existing vocabulary (a sentencepiece file), each weighted by
the product of its pieces' unigram probabilities: a forward recursion in log space over the word's lattice. Piece
probabilities start from the training words as the vocabulary's own tokenizer cuts them; ``ROUNDS`` rounds of
expectation maximisation over the distinct training words (forward and backward recursion) then count each piece by its
share of all segmentations. Add-one smoothing covers all pieces and the end. Single bytes are pieces, so every word has
a path. Many words are walked through the trie of pieces at once, a word longer than ``BLOCK_BYTES`` in stretches.

Distinct words and counts go from chunks of documents to hash buckets; a bucket merges them, so each distinct word of
the corpus is segmented and scored once, however often it occurs. Buckets answer each chunk with counts and log
probabilities in the order in which it sent its words. Only piece counts (bounded by the vocabulary) and four totals reach
the driver, once a round. Expected counts are summed in whole units of 2^-20, so the order of tasks does not change them. Words
are told apart by a 64-bit hash within a bucket.

Training: documents whose crc32(doc_id as text) modulo ``FOLDS`` is not ``HELD_OUT`` (a null doc_id counts as ''). A null
or empty text has one token, its end. Rows repeated in full count each time. Without training documents all counts are 0
and pieces are equally likely. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtable.llm.common import (chunk_count, pack, pack_sorted, read_table, settle, slices, split_buckets, text_buffer, unpack,
                                 unpack_sorted, word_bounds, word_hashes)

FOLDS, HELD_OUT = 7, 2
VOCABULARY = "piece_bpe_32k.model"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE_MARK = "▁".encode()
ROUNDS = 2
BLOCK_BYTES = 1 << 17
UNIT = 1 << 20
LN10 = math.log(10)


def _words(texts):
    """For slices of documents: (first document, lowered bytes, word starts, ends, hashes, words per document)."""
    data, off = text_buffer(texts)
    for i, j in slices(off):
        part, o = LOWER[data[off[i] : off[j]]], off[i : j + 1] - off[i]
        starts, ends, first = word_bounds(part, o)
        yield i, part, starts, ends, word_hashes(part, starts, ends), np.diff(first)


def distinct_words(table):
    """Sorted hashes of a chunk's distinct words, their training counts and their bytes."""
    train = ~table["held_out"].to_numpy(zero_copy_only=False)
    keys, counts, lens, blobs = [], [], [], []
    for i, part, starts, ends, h, count in _words(table["text"]):
        in_train = np.repeat(train[i : i + len(count)], count)
        k, at, back = np.unique(h, return_index=True, return_inverse=True)
        keys.append(k)
        counts.append(np.bincount(back, in_train, len(k)).astype(np.int64))
        n = ends[at] - starts[at]
        lens.append(n)
        where = np.repeat(starts[at] - np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else starts[at], n) + np.arange(int(n.sum()))
        blobs.append(part[where])
    return merge_words(keys, counts, lens, blobs)


def merge_words(keys, counts, lens, blobs):
    """One entry for each distinct hash, in order of the hash: (hashes, counts, lengths, bytes)."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    h, n, blob = np.concatenate(keys), np.concatenate(lens), np.concatenate(blobs)
    start = np.cumsum(n) - n
    k, at, back = np.unique(h, return_index=True, return_inverse=True)
    c = np.bincount(back, np.concatenate(counts), len(k)).astype(np.int64)
    n, start = n[at], start[at]
    where = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return k, c, n, blob[where]


class Pieces:
    """The different byte strings of a vocabulary's pieces, in a trie."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        number: dict[bytes, int] = {}
        self.of_id = np.full(sp.get_piece_size(), -1)
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i)):
                piece = sp.id_to_piece(i)
                self.of_id[i] = number.setdefault(bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.encode(), len(number))
        self.texts = list(number)
        nodes = {b"": 0}  # those with children first
        for text in self.texts:
            for j in range(1, len(text)):
                nodes.setdefault(text[:j], len(nodes))
        self.inner = len(nodes)
        for text in self.texts:
            nodes.setdefault(text, len(nodes))
        self.piece = np.full(len(nodes), -1, np.int32)
        self.next = np.zeros((self.inner, 256), np.min_scalar_type(len(nodes)))  # 0: no such piece
        for text, node in nodes.items():
            self.piece[node] = number.get(text, -1)
            if node:
                self.next[nodes[text[:-1]], text[-1]] = node

    def arcs(self, data, stop, at):
        """Pieces that start at the bytes ``at`` and end in their words: (first byte, length, piece)."""
        found, size = [], 1
        node = self.next[0, data[at]]
        while True:
            on = node > 0
            at, node = at[on], node[on]
            if not len(at):
                break
            hit = np.flatnonzero(self.piece[node] >= 0)
            found.append((at[hit], np.full(len(hit), size), self.piece[node[hit]]))
            go = np.flatnonzero((node < self.inner) & (at + size < stop[at]))
            at, node = at[go], node[go]
            node = self.next[node, data[at + size]]
            size += 1
        return [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 3


@functools.lru_cache(maxsize=1)
def pieces_of(model: bytes) -> Pieces:
    """Once for each worker process."""
    return Pieces(model)


def log_probabilities(counts: np.ndarray, n_end: int) -> tuple[np.ndarray, float]:
    """Add-one log probabilities of all pieces, and of the end."""
    total = math.log(float(counts.sum()) + n_end + len(counts) + 1)
    return np.log(counts + 1.0) - total, math.log(n_end + 1) - total


def _steps(key: np.ndarray):
    """An order by key, and the ranges of equal keys in it."""
    order = np.argsort(key.astype(np.min_scalar_type(int(key.max(initial=0)))), kind="stable")
    cut = np.flatnonzero(np.diff(key[order], prepend=-1))
    return order, list(zip(cut.tolist(), [*cut[1:].tolist(), len(key)]))


def marginals(pieces: Pieces, log_p: np.ndarray, data: np.ndarray, lens: np.ndarray, counts: np.ndarray | None = None, block: int = BLOCK_BYTES):
    """Log probability of each word over all its segmentations; with the words' counts also the expected count of each piece.

    ``data`` holds the words one after the other, each with its mark. A state is a place between two bytes of a word. All
    arcs that start as many bytes into their words end in different states, and all arcs that end as many bytes into them
    start in different states; so each step adds to a state once."""
    n = len(lens)
    first = np.cumsum(lens) - lens
    word = np.repeat(np.arange(n), lens)
    stop, into = (first + lens)[word], np.arange(len(data)) - first[word]
    opens = first + np.arange(n)
    closes = opens + lens
    blocks = range(0, int(lens.max(initial=0)), block)

    @functools.lru_cache(maxsize=1)
    def arcs(a):
        whole = len(blocks) == 1
        at, size, piece = pieces.arcs(data, stop, np.arange(len(data)) if whole else np.flatnonzero((into >= a) & (into < a + block)))
        return into[at], size, at + word[at], piece

    alpha = np.full(len(data) + n, -np.inf)
    alpha[opens] = 0.0
    for a in blocks:
        start, size, state, piece = arcs(a)
        order, ranges = _steps(start)
        src, gain = state[order], log_p[piece[order]]
        dst = src + size[order]
        for i, j in ranges:
            alpha[dst[i:j]] = np.logaddexp(alpha[dst[i:j]], alpha[src[i:j]] + gain[i:j])
    if counts is None:
        return alpha[closes]
    beta = np.full(len(data) + n, -np.inf)
    beta[closes] = 0.0
    of_state = np.repeat(np.arange(n), lens + 1)
    expected = np.zeros(len(log_p))
    for a in reversed(blocks):
        start, size, state, piece = arcs(a)
        order, ranges = _steps(start + size)
        src, piece = state[order], piece[order]
        dst, gain = src + size[order], log_p[piece]
        for i, j in reversed(ranges):
            beta[src[i:j]] = np.logaddexp(beta[src[i:j]], beta[dst[i:j]] + gain[i:j])
        of = of_state[src]
        expected += np.bincount(piece, np.exp(alpha[src] + gain + beta[dst] - alpha[closes][of]) * counts[of], len(log_p))
    return alpha[closes], expected


def marked_words(lens: np.ndarray, blob: np.ndarray):
    """Stretches of words with a mark before each: (first word, after the last, bytes, lengths)."""
    edge = np.concatenate(([0], np.cumsum(lens)))
    for i, j in slices(edge, BLOCK_BYTES):
        n = lens[i:j] + len(SPACE_MARK)
        data, own = np.empty(int(n.sum()), np.uint8), np.ones(int(n.sum()), bool)
        for k, byte in enumerate(SPACE_MARK):
            data[np.cumsum(n) - n + k] = byte
            own[np.cumsum(n) - n + k] = False
        data[own] = blob[edge[i] : edge[j]]
        yield i, j, data, n


def score_documents(docs: DataFrame, vocabulary: str | None = None, folds: int = FOLDS, held_out: int = HELD_OUT,
                    rounds: int = ROUNDS) -> DataFrame:
    spark = docs.sparkSession
    with open(vocabulary or public_tokenizers.path(VOCABULARY), "rb") as f:
        model = spark.sparkContext.broadcast(f.read())  # half a megabyte, whatever the input
    chunks = chunk_count(docs)
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(folds))
    src = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"), "doc_id", "text", (fold == held_out).alias("held_out"))

    def send(key, table):
        k, c, n, blob = distinct_words(table)
        edge = np.concatenate(([0], np.cumsum(n)))
        rows = [(b, pack_sorted(k[i:j]), pack(c[i:j].astype(np.uint32)), pack(n[i:j].astype(np.uint32)), zstandard.compress(blob[edge[i] : edge[j]].tobytes(), 1)) for b, i, j in split_buckets(k, chunks)]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "chunk": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                         **{name: pa.array([r[x] for r in rows], pa.binary()) for x, name in enumerate(("keys", "counts", "lens", "blob"), 1)}})

    def merge(key, table):
        lists = [unpack_sorted(x.as_py()) for x in table["keys"]]
        k, c, n, blob = merge_words(lists, [unpack(x.as_py(), np.uint32) for x in table["counts"]], [unpack(x.as_py(), np.uint32).astype(np.int64) for x in table["lens"]],
                                    [np.frombuffer(zstandard.decompress(x.as_py()), np.uint8) for x in table["blob"]])
        b = key[0].as_py()
        where = [pack_sorted(np.searchsorted(k, x).astype(np.uint32)) for x in lists]
        m = len(lists)
        return pa.table({"bucket": pa.array([b] * (m + 1), pa.int32()), "chunk": pa.concat_arrays([pa.nulls(1, pa.int32()), table["chunk"].combine_chunks()]),
                         "places": pa.array([None, *where], pa.binary()), "counts": pa.array([pack(c)] + [None] * m, pa.binary()),
                         "lens": pa.array([pack(n)] + [None] * m, pa.binary()), "blob": pa.array([zstandard.compress(blob.tobytes(), 1)] + [None] * m, pa.binary()),
                         "n_tokens": pa.array([int(c.sum())] + [0] * m, pa.int64()), "n_types": pa.array([int((c > 0).sum())] + [0] * m, pa.int64())})

    words = settle(src.groupBy("chunk").applyInArrow(send, "bucket int, chunk int, keys binary, counts binary, lens binary, blob binary")
                   .groupBy("bucket").applyInArrow(merge, "bucket int, chunk int, places binary, counts binary, lens binary, blob binary, n_tokens long, n_types long"), free=True)

    def cut(batches):
        import sentencepiece

        sp, of_id = sentencepiece.SentencePieceProcessor(model_proto=model.value), pieces_of(model.value).of_id
        total = np.zeros(int(of_id.max()) + 1, np.int64)
        for batch in batches:
            for counts, lens, blob in zip(batch["counts"].to_pylist(), batch["lens"].to_pylist(), batch["blob"].to_pylist()):
                c, text = unpack(counts, np.int64), zstandard.decompress(blob)
                edge = np.concatenate(([0], np.cumsum(unpack(lens, np.int64))))
                seen = np.flatnonzero(c)
                for a in range(0, len(seen), 20_000):
                    some = seen[a : a + 20_000]
                    ids = sp.encode([text[x:y].decode() for x, y in zip(edge[some].tolist(), edge[some + 1].tolist())], num_threads=1)
                    at = of_id[np.fromiter((i for x in ids for i in x), np.int64)]
                    times = np.repeat(c[some], [len(x) for x in ids])
                    np.add.at(total, at[at >= 0], times[at >= 0])
        yield counted(total * UNIT)

    def counted(total):
        at = np.flatnonzero(total)
        return pa.record_batch({"piece": pa.array(at.astype(np.int32)), "n": pa.array(total[at])})

    def expect(batches):
        pieces = pieces_of(model.value)
        total = np.zeros(len(pieces.texts), np.int64)
        for batch in batches:
            for counts, lens, blob in zip(batch["counts"].to_pylist(), batch["lens"].to_pylist(), batch["blob"].to_pylist()):
                c, n, text = unpack(counts, np.int64), unpack(lens, np.int64), np.frombuffer(zstandard.decompress(blob), np.uint8)
                seen = c > 0
                text = text[np.repeat(seen, n)]
                c, n = c[seen], n[seen]
                for i, j, data, some in marked_words(n, text):
                    total += np.rint(marginals(pieces, learned.value, data, some, c[i:j])[1] * UNIT).astype(np.int64)
        yield counted(total)

    tables = words.where("chunk is null")
    n_words, n_types = tables.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_types"), F.lit(0))).first()
    n_train = src.where(~F.col("held_out")).count()
    total, types = n_words + n_train, n_types + (n_train > 0)
    size = len(Pieces(model.value).texts)

    def probabilities(count):
        n = np.zeros(size)
        for r in tables.select("counts", "lens", "blob").mapInArrow(count, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect():
            n[r["piece"]] = r["n"] / UNIT  # at most one row a piece
        return log_probabilities(n, n_train)

    log_p, end = probabilities(cut)
    for _ in range(rounds):
        learned = spark.sparkContext.broadcast(log_p)
        log_p, end = probabilities(expect)
    learned, end_p = spark.sparkContext.broadcast(log_p), end / LN10

    def answer(key, table):
        pieces = pieces_of(model.value)
        counts = log_p = np.zeros(0)
        for c, lens, blob in zip(table["counts"].to_pylist(), table["lens"].to_pylist(), table["blob"].to_pylist()):
            if c is not None:
                counts, n = unpack(c, np.int64), unpack(lens, np.int64)
                log_p = np.concatenate([np.zeros(0), *(marginals(pieces, learned.value, data, some) / LN10
                                                       for _, _, data, some in marked_words(n, np.frombuffer(zstandard.decompress(blob), np.uint8)))])
        rows = [(c, pack(counts[i]), pack(log_p[i])) for c, i in
                ((c, unpack_sorted(p, np.uint32)) for c, p in zip(table["chunk"].to_pylist(), table["places"].to_pylist()) if c is not None)]
        return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int32()), "bucket": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                         "counts": pa.array([r[1] for r in rows], pa.binary()), "log_p": pa.array([r[2] for r in rows], pa.binary())})

    # a bucket's bytes are few and its work is not: a given number of partitions is not merged into fewer
    replies = words.select("bucket", "chunk", "places", "counts", "lens", "blob").repartition(chunks, "bucket").groupBy("bucket").applyInArrow(answer, "chunk int, bucket int, counts binary, log_p binary")
    under = math.log10(total + types + 1)
    end_count = n_train

    def score(key, table, reply):
        k, *_ = distinct_words(table)
        order = np.argsort(reply["bucket"].to_numpy())
        got = lambda name, t: np.concatenate([np.zeros(0, t), *(unpack(reply[name][int(i)].as_py(), t) for i in order)])
        counts, log_p = got("counts", np.int64), got("log_p", np.float64)
        base_of = np.log10(counts + 1.0) - under
        n = table.num_rows
        tokens, known, base, own = np.ones(n, np.int64), np.full(n, int(end_count > 0)), np.full(n, math.log10(end_count + 1) - under), np.full(n, end_p)
        for i, _, _, _, h, count in _words(table["text"]):
            at = np.searchsorted(k, h)
            doc = np.repeat(np.arange(i, i + len(count)), count)
            tokens[i : i + len(count)] += count
            known += np.bincount(doc, counts[at] > 0, n).astype(np.int64)
            base += np.bincount(doc, base_of[at], n)
            own += np.bincount(doc, log_p[at], n)
        return pa.table({"doc_id": table["doc_id"], "held_out": table["held_out"], "n_tokens": pa.array(tokens), "n_known": pa.array(known),
                         "train_tokens": pa.array(np.full(n, total)), "base_score": pa.array(base), "score": pa.array(own)})

    return src.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op5(spark, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"))
