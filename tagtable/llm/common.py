"""Helpers the operators of this subpackage share.

Texts are handled as Arrow buffers with numpy: one pass of array operations over a batch replaces a Python loop over
words. ``chunk`` columns deal the documents into groups of about ``CHUNK_BYTES`` of text by a hash of the whole row,
so no key, source or group of copies can make a chunk large; the number of chunks grows with the input.
"""

from __future__ import annotations

import gc
import time

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtable.session import ensure_checkpoint_dir

CHUNK_BYTES = 4 << 20
SLICE_BYTES = 2 << 20
NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id inside numpy code: after all others

_rng = np.random.default_rng(20240229)
BYTE_MIX = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
GRAM_MIX = np.uint64(0x9E3779B97F4A7C15)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = SLICE_BYTES):
    """Ranges of whole documents with about ``limit`` bytes each (a longer document alone)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_bounds(data: np.ndarray, off: np.ndarray, apart: np.ndarray = IS_SPACE):
    """Start and end byte of each word, and for each document the number of its first word."""
    inside = np.append(~apart[data], False)
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    first = np.concatenate(([0], np.cumsum(lens)[:-1]))
    at = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(first, lens)
    powers = np.cumprod(np.full(int(lens.max()), GRAM_MIX, np.uint64))
    each = BYTE_MIX[data[at + np.repeat(starts, lens)]] * powers[at]
    return mix(np.add.reduceat(each, first) + lens.astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that start at each position (over document ends too; mask those)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * GRAM_MIX + words[j : n + j]
    return mix(h)


def grams_of(texts: pa.Array, k: int):
    """For slices of documents: (first document, hashes, document of each, start word of each, words per document)."""
    data, off = text_buffer(texts)
    for i, j in slices(off):
        part, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
        starts, ends, first = word_bounds(part, o)
        h = gram_hashes(word_hashes(part, starts, ends), k)
        count = np.diff(first)
        doc = np.repeat(np.arange(j - i), count)[: len(h)]
        start = np.arange(len(h)) - first[doc]
        whole = start + k <= count[doc]
        yield i, h[whole], doc[whole] + i, start[whole], count


def pack_sorted(x: np.ndarray) -> bytes:
    """Sorted unsigned integers as compressed byte planes of their differences."""
    d = np.diff(x, prepend=x.dtype.type(0))
    return zstandard.compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, x.dtype.itemsize).T).tobytes(), 1)


def unpack_sorted(b: bytes, dtype=np.uint64) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.decompress(b), np.uint8).reshape(size, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(dtype), dtype=dtype)


def pack(x: np.ndarray) -> bytes:
    size = x.dtype.itemsize
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, size).T).tobytes(), 1)


def unpack(b: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(b), np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def split_buckets(keys: np.ndarray, n: int):
    """Ranges of sorted 64-bit hashes that fall into each of n equal ranges of hash space: (bucket, from, to)."""
    bucket = bucket_of(keys, n)
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(cut, np.append(cut[1:], len(keys))):
        yield int(bucket[a]), int(a), int(b)


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def is_in(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def ids_of(col: pa.ChunkedArray) -> np.ndarray:
    return col.fill_null(int(NO_ID)).to_numpy().astype(np.int64)


def chunk_count(docs: DataFrame, text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> int:
    size = docs.agg(F.sum(F.octet_length(text) + F.lit(64))).first()[0] or 0
    return max(1, -(-int(size) // chunk_bytes))


def with_chunk(docs: DataFrame, n: int) -> DataFrame:
    """(row_key, chunk, doc_id, text): row_key tells rows apart, but for rows that are equal in both columns."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key")).select(
        F.pmod("row_key", F.lit(n)).cast("int").alias("chunk"), "row_key", "doc_id", "text")


def settle(df: DataFrame, free: bool = False) -> DataFrame:
    """Reliable checkpoint in the shared folder; with ``free`` the shuffle files of the job that made it go first."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    out = df.checkpoint(eager=True)
    del df  # the executed plan holds its shuffles
    if free:
        free_shuffles(spark)
    return out


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's context cleaner drop the shuffle files nothing refers to any more. It acts when garbage is collected,
    which a driver with a quiet heap may not do for long; the last references go a second or two after a job."""
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)
