"""Removal of passages that an earlier document holds, by suffix automata of reference shards.

A window is ``n`` consecutive words. Each word covered by a window that also starts in a document with a smaller
doc_id goes.

1. Every chunk of documents sends short hashes of its windows to hash buckets; buckets answer which recur (a filter
   without false negatives).
2. Windows that passed send their 64-bit hash and documents; buckets answer with the first document (the owner).
3. Each run of windows that a document owns is a reference passage; passages are dealt to shards by owner. Each run of
   windows with an earlier owner is a query, sent to that owner's shard. Equal queries are merged before they travel.
4. A shard builds the suffix automaton of its passages; every query streams through it. The matching statistics
   (longest match that ends at each word) decide: where a match of ``n`` words has an occurrence in a smaller
   doc_id, its span is removed. Hashes only route; the automaton compares words.
5. Spans go back to their chunk and the kept words are joined.

A shard is sent only the queries it can answer; broadcasting every shard to every document would multiply shards by
documents. Windows are judged on the input. Nulls: a null text has no words (its kept text is empty); a null doc_id
comes after all others. Rows repeated with the same doc_id do not remove each other. A text under ``n`` words is kept.
Words are bytes between white space (space, tab to carriage return); case and punctuation count. Extra input columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtable.llm.common import (bucket_of, chunk_count, grams_of, ids_of, is_in, pack, pack_sorted, settle,
                                 split_buckets, text_buffer, unpack, unpack_sorted, with_chunk)

WINDOW = 13
LOW32 = np.uint64(0xFFFFFFFF)


class SuffixAutomaton:
    """Suffix automaton over several word sequences; each state knows the smallest document that holds its words."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.doc = [-1], [0], [np.iinfo(np.int64).max]

    def add(self, words: list, doc: int) -> None:
        nxt, link, length, docs = self.next, self.link, self.length, self.doc
        last = 0
        for w in words:
            q = nxt[last].get(w)
            if q is not None and length[q] == length[last] + 1:
                last = q
                if doc < docs[last]:
                    docs[last] = doc
                continue
            cur = -1
            if q is None:
                cur = len(nxt)
                nxt.append({})
                length.append(length[last] + 1)
                link.append(0)
                docs.append(doc)
                p = last
                while p >= 0 and w not in nxt[p]:
                    nxt[p][w] = cur
                    p = link[p]
                if p < 0:
                    last = cur
                    continue
                q = nxt[p][w]
                if length[q] == length[p] + 1:
                    link[cur] = q
                    last = cur
                    continue
            else:
                p = last
            clone = len(nxt)
            nxt.append(dict(nxt[q]))
            length.append(length[p] + 1)
            link.append(link[q])
            docs.append(docs[q] if cur >= 0 else min(docs[q], doc))
            while p >= 0 and nxt[p].get(w) == q:
                nxt[p][w] = clone
                p = link[p]
            link[q] = clone
            if cur >= 0:
                link[cur] = clone
                last = cur
            else:
                last = clone

    def finish(self) -> None:
        """Hand each state's document down its suffix links, longest first."""
        for v in np.argsort(-np.asarray(self.length), kind="stable").tolist():
            u = self.link[v]
            if u > 0 and self.doc[v] < self.doc[u]:
                self.doc[u] = self.doc[v]

    def match(self, words: list, cap: int):
        """At each word: length of the longest match that ends there, ``cap`` at most, and its smallest document."""
        nxt, link, length, docs = self.next, self.link, self.length, self.doc
        v, n = 0, 0
        for w in words:
            while v and w not in nxt[v]:
                v = link[v]
                n = length[v]
            t = nxt[v].get(w)
            if t is None:
                n = 0
            else:
                v, n = t, n + 1
            if n > cap:
                n = cap
            while length[link[v]] >= n and v and link[v] >= 0 and n:
                v = link[v]
            yield n, docs[v]


def _runs(mask: np.ndarray, same: np.ndarray):
    """Ranges of consecutive true positions with equal ``same``."""
    at = np.flatnonzero(mask)
    if not len(at):
        return
    cut = np.flatnonzero((np.diff(at) != 1) | (same[at[1:]] != same[at[:-1]])) + 1
    for part in np.split(at, cut):
        yield int(part[0]), int(part[-1]) + 1


def _windows(table: pa.Table, n: int):
    parts = [(h, doc, start) for _, h, doc, start, _ in grams_of(table["text"], n)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def find_spans(docs: DataFrame, n: int = WINDOW) -> tuple[DataFrame, DataFrame, int]:
    """Chunked documents, the spans to remove (chunk, packed row keys, starts and ends in words), number of chunks."""
    chunks = chunk_count(docs)
    src = with_chunk(docs, chunks)

    def short(key, table):
        h, doc, _ = _windows(table, n)
        order = np.lexsort((ids_of(table["doc_id"])[doc], h))
        h, d = h[order], ids_of(table["doc_id"])[doc[order]]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        h = h[new]
        if len(h) > 2:  # two documents of a chunk are enough to show that a window recurs
            third = np.concatenate(([False, False], h[2:] == h[:-2]))
            h = h[~third]
        rows = [(b, key[0].as_py(), pack_sorted(np.sort((h[i:j] & LOW32).astype(np.uint32)))) for b, i, j in split_buckets(h, chunks)]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "chunk": pa.array([r[1] for r in rows], pa.int32()),
                         "keys": pa.array([r[2] for r in rows], pa.binary())})

    def recurring(key, table):
        lists = [unpack_sorted(b.as_py(), np.uint32) for b in table["keys"]]
        every = np.sort(np.concatenate(lists))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        kept = [np.unique(x[is_in(x, twice)]) for x in lists]
        keep = [i for i, x in enumerate(kept) if len(x)]
        return pa.table({"chunk": table["chunk"].take(pa.array(keep, pa.int64())) if keep else pa.array([], pa.int32()),
                         "bucket": pa.array([key[0].as_py()] * len(keep), pa.int32()),
                         "keys": pa.array([pack_sorted(kept[i]) for i in keep], pa.binary())})

    hints = (src.groupBy("chunk").applyInArrow(short, "bucket int, chunk int, keys binary")
             .groupBy("bucket").applyInArrow(recurring, "chunk int, bucket int, keys binary"))

    def long(key, table, hint):
        out = {"bucket": [], "keys": [], "first": [], "several": []}
        if table.num_rows and hint.num_rows:
            h, doc, _ = _windows(table, n)
            full = lambda x, b: x.astype(np.uint64) | (np.uint64(b) << np.uint64(32))
            known = np.sort(np.concatenate([full(unpack_sorted(k.as_py(), np.uint32), b.as_py()) for b, k in zip(hint["bucket"], hint["keys"])]))
            hit = is_in((h & LOW32) | (bucket_of(h, chunks).astype(np.uint64) << np.uint64(32)), known)
            h, d = h[hit], ids_of(table["doc_id"])[doc[hit]]
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            start = np.flatnonzero(np.diff(h, prepend=~h[:1]) != 0) if len(h) else np.zeros(0, np.int64)
            end = np.append(start[1:], len(h)) - 1
            first, several, h = d[start], d[start] < d[end], h[start]
            for b, i, j in split_buckets(h, chunks):
                out["bucket"].append(b)
                out["keys"].append(pack_sorted(h[i:j]))
                out["first"].append(pack(first[i:j]))
                out["several"].append(np.packbits(several[i:j]).tobytes())
        c = key[0].as_py()
        return pa.table({"bucket": pa.array(out["bucket"], pa.int32()), "chunk": pa.array([c] * len(out["bucket"]), pa.int32()),
                         **{k: pa.array(out[k], pa.binary()) for k in ("keys", "first", "several")}})

    def owners(key, table):
        lists = [unpack_sorted(b.as_py()) for b in table["keys"]]
        h = np.concatenate(lists)
        first = np.concatenate([unpack(b.as_py(), np.int64) for b in table["first"]])
        several = np.concatenate([np.unpackbits(np.frombuffer(b.as_py(), np.uint8))[: len(x)] for b, x in zip(table["several"], lists)])
        order = np.argsort(h, kind="stable")
        start = np.flatnonzero(np.diff(h[order], prepend=~h[order][:1]) != 0)
        low, high, names = np.minimum.reduceat(first[order], start), np.maximum.reduceat(first[order], start), h[order][start]
        many = (low < high) | (np.maximum.reduceat(several[order], start) > 0)
        names, low = names[many], low[many]
        rows = []
        for c, x in zip(table["chunk"].to_pylist(), lists):
            x = x[is_in(x, names)]
            if len(x):
                rows.append((c, pack_sorted(x), pack(low[np.searchsorted(names, x)])))
        return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int32()), "keys": pa.array([r[1] for r in rows], pa.binary()),
                         "owner": pa.array([r[2] for r in rows], pa.binary())})

    owned = (src.groupBy("chunk").cogroup(hints.groupBy("chunk"))
             .applyInArrow(long, "bucket int, chunk int, keys binary, first binary, several binary")
             .groupBy("bucket").applyInArrow(owners, "chunk int, keys binary, owner binary"))

    def passages(key, table, reply):
        refs, asks = [], {}
        if table.num_rows and reply.num_rows:
            known = np.concatenate([unpack_sorted(b.as_py()) for b in reply["keys"]])
            owner = np.concatenate([unpack(b.as_py(), np.int64) for b in reply["owner"]])
            order = np.argsort(known)
            known, owner = known[order], owner[order]
            ids, rows = ids_of(table["doc_id"]), table["row_key"].to_numpy()
            data, off = text_buffer(table["text"])
            for i, h, doc, start, count in grams_of(table["text"], n):
                hit = is_in(h, known)
                who = np.where(hit, owner[np.minimum(np.searchsorted(known, h), len(known) - 1)], -1)
                at = np.searchsorted(doc, np.arange(i, i + len(count) + 1))
                for k in np.unique(doc[hit]).tolist():
                    a, b = at[k - i], at[k - i + 1]
                    mine, w = ids[k], who[a:b]
                    words = bytes(data[off[k] : off[k + 1]]).split()
                    for s, e in _runs(hit[a:b] & (w == mine), w):
                        refs.append((int(mine), b" ".join(words[s : e + n - 1])))
                    for s, e in _runs(hit[a:b] & (w < mine), w):
                        asks.setdefault((int(w[s]), b" ".join(words[s : e + n - 1])), []).append((rows[k], int(mine), s))
        c = key[0].as_py()
        refs = list(dict.fromkeys(refs))
        names = [*(hashlib.md5(t).hexdigest() for _, t in refs), *(hashlib.md5(t).hexdigest() for _, t in asks)]
        blob = lambda f, t: [None] * len(refs) + [np.array([f(x) for x in v], t).tobytes() for v in asks.values()]
        return pa.table({"owner": pa.array([*(o for o, _ in refs), *(o for o, _ in asks)], pa.int64()), "chunk": pa.array([c] * len(names), pa.int32()),
                         "asked": pa.array([False] * len(refs) + [True] * len(asks)), "name": pa.array(names, pa.string()),
                         "words": pa.array([*(t for _, t in refs), *(t for _, t in asks)], pa.binary()),
                         "row_keys": pa.array(blob(lambda x: x[0], np.int64), pa.binary()), "doc_ids": pa.array(blob(lambda x: x[1], np.int64), pa.binary()),
                         "starts": pa.array(blob(lambda x: x[2], np.int64), pa.binary())})

    found = settle(src.groupBy("chunk").cogroup(owned.groupBy("chunk")).applyInArrow(
        passages, "owner long, chunk int, asked boolean, name string, words binary, row_keys binary, doc_ids binary, starts binary"), free=True)

    def stream(key, table):
        sam, asked = SuffixAutomaton(), table["asked"].to_pylist()
        owner, texts, names = table["owner"].to_pylist(), table["words"].to_pylist(), table["name"].to_pylist()
        for a, o, t in zip(asked, owner, texts):
            if not a:
                sam.add(t.split(), o)
        sam.finish()
        out = []
        for a, o, t, name in zip(asked, owner, texts, names):
            if a:  # ends of matches of n words, with the smallest document that holds them
                got = [(i + 1, d) for i, (m, d) in enumerate(sam.match(t.split(), n)) if m >= n]
                if got:
                    out.append((o, name, np.array([x for x, _ in got], np.int64).tobytes(), np.array([d for _, d in got], np.int64).tobytes()))
        return pa.table({k: pa.array([r[i] for r in out], t) for i, (k, t) in enumerate((("owner", pa.int64()), ("name", pa.string()), ("ends", pa.binary()), ("holders", pa.binary())))})

    asks = found.where("asked")
    distinct = found.groupBy("asked", "owner", "name").agg(F.first("words").alias("words"))
    verified = (distinct.withColumn("shard", F.pmod(F.xxhash64("owner"), F.lit(chunks)).cast("int"))
                .groupBy("shard").applyInArrow(stream, "owner long, name string, ends binary, holders binary"))
    spans = asks.select("owner", "name", "chunk", "row_keys", "doc_ids", "starts").join(verified, ["owner", "name"])
    return src, spans.select("chunk", "row_keys", "doc_ids", "starts", "ends", "holders"), chunks


def remove_spans(src: DataFrame, spans: DataFrame, n: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space)."""

    def apply(key, table, found):
        ends_of: dict[int, list] = {}
        for r in found.select(["row_keys", "doc_ids", "starts", "ends", "holders"]).to_pylist():
            ends, holders = np.frombuffer(r["ends"], np.int64), np.frombuffer(r["holders"], np.int64)
            for k, d, s in zip(np.frombuffer(r["row_keys"], np.int64).tolist(), np.frombuffer(r["doc_ids"], np.int64).tolist(), np.frombuffer(r["starts"], np.int64).tolist()):
                ends_of.setdefault(k, []).append(ends[holders < d] + s)
        data, off = text_buffer(table["text"])
        words_n, gone_n, kept = [], [], []
        for i, k in enumerate(table["row_key"].to_pylist()):
            words = bytes(data[off[i] : off[i + 1]]).split()
            hits = ends_of.get(k)
            if hits:
                ends = np.concatenate(hits)
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, ends - n, 1)
                np.add.at(edge, ends, -1)
                left = np.cumsum(edge)[:-1] == 0
                gone_n.append(len(words) - int(left.sum()))
                words_n.append(len(words))
                words = [words[x] for x in np.flatnonzero(left).tolist()]
            else:
                words_n.append(len(words))
                gone_n.append(0)
            kept.append(b" ".join(words))
        return pa.table({"doc_id": table["doc_id"], "n_words": pa.array(words_n, pa.int64()), "n_removed": pa.array(gone_n, pa.int64()),
                         "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    return src.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(apply, "doc_id long, n_words long, n_removed long, kept string")


def substring_dedup(docs: DataFrame, n: int = WINDOW) -> DataFrame:
    src, spans, _ = find_spans(docs, n)
    return remove_spans(src, spans, n)


def op1(spark, sf_dir: str) -> DataFrame:
    from tagtable.llm.common import read_table

    out = substring_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
