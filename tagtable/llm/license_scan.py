"""License scans: fuzzy search for short notices.

Texts are lowered (A-Z) and taken as words, runs of bytes other than ASCII marks, blanks and controls. Base finds are
places where the words of a phrase stand consecutively. The method looks for whole notices with edits: a notice that
may differ by ``k`` characters is cut into k + 1 seeds, of which one must occur unchanged (pigeonhole). Exact seed
finds give candidate places, those with too few common trigrams are dropped, and the regex library's bounded-error matching verifies each place and reports span and edits.

Every text is searched whole; a task works on the buffer of a batch, so there is nothing to shuffle. A null or empty
text has no words and no labels. Ties between equally good matches go to the first. Rows repeated in full give equal
rows. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtable.llm.common import read_table, slices, text_buffer

# Phrases of the base finds and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Short notices of well-known licenses, as words. Matching a place costs more with each edit allowed, so new ones stay under 70 characters.
NOTICES = {
    "agpl": "gnu affero general public license",
    "apache": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "bsl": "boost software license version 1 0",
    "cc-by": "creative commons attribution 4 0 international",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "creative commons attribution sharealike 4 0 international",
    "cc0": "related and neighboring rights to this software",
    "epl": "under the terms of the eclipse public license",
    "gfdl": "under the terms of the gnu free documentation license",
    "gpl": "licensed under the gnu general public license version 3",
    "isc": "to use copy modify and or distribute this software for any purpose",
    "lgpl": "gnu lesser general public license",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "ofl": "under the sil open font license version 1 1",
    "unlicense": "this is free and unencumbered software",
    "wtfpl": "verbatim or modified copies of this license document",
    "zlib": "in no event will the authors be held liable for any damages",
}
EDIT_SHARE = 10  # one edit for so many characters
SPAN = "array<struct<label:string,first_word:long,last_word:long,edits:int,base:boolean>>"

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def normalised(data: np.ndarray, off: np.ndarray):
    """Words with one space before each and one after the last of a document: (bytes, word starts, words before each
    document, byte at which each document begins)."""
    low = LOWER[data]
    inside = WORD[low]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.append(inside[1:], False) if len(inside) else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    first = np.searchsorted(starts, off)
    n = ends - starts
    doc = np.searchsorted(off, starts, "right") - 1
    to = np.cumsum(n + 1) - n + doc  # a space before each word, one more after each document
    out = np.full(int(n.sum()) + len(n) + len(off) - 1, 0x20, np.uint8)
    shift = np.repeat(to - starts, n)
    at = np.flatnonzero(inside)
    out[at + shift] = low[at]
    begin = np.append(to, len(out) + 1)[first] - 1  # of documents without words: where the next one begins
    return out.tobytes(), to, first, begin


class Notice:
    def __init__(self, label: str, text: str, share: int = EDIT_SHARE) -> None:
        self.label, self.text, self.edits = label, text.encode(), max(1, len(text) // share)
        cut = np.linspace(0, len(self.text), self.edits + 2).astype(int).tolist()
        self.seeds = [(a, self.text[a:b]) for a, b in zip(cut, cut[1:])]
        self.grams = Counter(self.text[i : i + 3] for i in range(len(self.text) - 2))
        self.pattern = regex.compile(b"(?:" + regex.escape(self.text) + b"){e<=%d}" % self.edits, regex.BESTMATCH)

    def near(self, window: bytes) -> bool:
        """An edit spoils three trigrams at most, so a match keeps all but three for each."""
        have = Counter(window[i : i + 3] for i in range(len(window) - 2))
        return sum((self.grams & have).values()) >= len(self.text) - 2 - 3 * self.edits

    def find(self, raw: bytes, ends: np.ndarray):
        """(start, end, edits) of verified places; ``ends``: byte after each document."""
        tries = set()
        for shift, seed in self.seeds:
            at = raw.find(seed)
            while at >= 0:
                tries.add(at - shift)
                at = raw.find(seed, at + 1)
        last, found = -1, []
        for at in sorted(tries):
            doc = int(np.searchsorted(ends, max(at + len(self.text) // 2, 0), "right"))
            for d in (doc - 1, doc, doc + 1):  # the seed's document is next to the middle of the place at most
                if not 0 <= d < len(ends):
                    continue
                low, high = (int(ends[d - 1]) if d else 0), int(ends[d])
                a, b = max(low, at - self.edits), min(high, at + len(self.text) + self.edits)
                if b - a < len(self.text) - self.edits or not self.near(raw[a:b]):
                    continue
                m = self.pattern.search(raw, a, b)
                if m and m.start() > last:
                    found.append((m.start(), m.end(), sum(m.fuzzy_counts)))
                    last = m.end() - 1
        return found


def _scan(batches):
    notices = [Notice(k, v) for k, v in NOTICES.items()]
    kind = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32()), ("base", pa.bool_())]))
    for batch in batches:
        data, off = text_buffer(batch["text"])
        n_words, spans, scores = [], [], []
        for i, j in slices(off):
            raw, to, first, begin = normalised(data[off[i] : off[j]], off[i : j + 1] - off[i])
            ends = begin[1:]
            own: list[list] = [[] for _ in range(j - i)]
            best = [0.0] * (j - i)

            def put(label, a, b, edits, base, score):
                w0, w1 = int(np.searchsorted(to, a, "left")), int(np.searchsorted(to, b, "left")) - 1
                if w0 and to[w0 - 1] <= a and (w0 == len(to) or to[w0] > a):
                    w0 -= 1  # the match begins inside a word
                d = int(np.searchsorted(first, w0, "right")) - 1
                own[d].append({"label": label, "first_word": w0 - int(first[d]), "last_word": w1 - int(first[d]), "edits": edits, "base": base})
                best[d] = max(best[d], score)

            for phrase, label in PHRASES.items():
                needle = b" " + phrase.encode() + b" "
                at = raw.find(needle)
                while at >= 0:
                    put(label, at + 1, at + len(needle) - 1, 0, True, 1.0)
                    at = raw.find(needle, at + 1)
            for notice in notices:
                for a, b, edits in notice.find(raw, ends):
                    put(notice.label, a, b, edits, False, 1 - edits / len(notice.text))
            n_words += np.diff(first).tolist()
            spans += own
            scores += best
        yield pa.record_batch({"doc_id": batch["doc_id"], "n_words": pa.array(n_words, pa.int64()), "spans": pa.array(spans, kind), "score": pa.array(scores, pa.float64())})


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, spans (label, first and last word, edits, base) and the best score of each text."""
    return docs.select("doc_id", "text").mapInArrow(_scan, f"doc_id long, n_words long, spans {SPAN}, score double")


def op7(spark, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["base"])
    labels = lambda x: F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda s: s["label"]))), ",")
    starts = F.transform(base, lambda s: s["first_word"])
    return scan_licenses(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"), "score")
