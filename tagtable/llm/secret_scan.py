"""Secret scans with corpus-wide ownership frequency.

Kinds found by pattern (leftmost, not overlapping within a kind; offsets in code points, end exclusive):
  assign  a name such as password or api_key, a separator and a value of 6 or more characters
  access  AKIA and capitals or digits, 20 characters or more
  hex     24 or more lower-case hexadecimal digits
The method adds kind ``live``: other opaque strings (20 or more of the characters of keys, with letters and digits and
an entropy of 3 bits or more a character) that the corpus shows to belong to few owners.

Each candidate's value is hashed; the corpus is aggregated to (value, owner, repository, text) and then to the number of
distinct owners, repositories and texts of each value. Values with more than ``MAX_OWNERS`` owners, ``MAX_REPOS``
repositories or ``MAX_TEXTS`` different texts are widely copied examples, also when one large owner holds them all; the rest
look live. Base spans stay whatever their frequency, with the verdict and the three numbers beside them.

An owner is a document's source, a repository a source and language (a null counts as a name of its own). A null or empty
text has no spans. Rows repeated in full and copies of a text in its repository are scanned alike and change no number. Patterns use ASCII
case. A document without spans has empty strings. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtable.llm.common import read_table, settle

MAX_OWNERS, MAX_REPOS, MAX_TEXTS = 2, 4, 100
KINDS = ("assign", "access", "hex", "live")
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is the whole leftmost run
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
MAYBE = r"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{24}|[A-Za-z0-9+/_=-]{20}"
MIN_ENTROPY = 3.0
MASK = "[removed]"
SPAN = "array<struct<start:long,end:long,kind:int,value:string>>"
JUDGED = "array<struct<start:long,kind:int,end:long,live:boolean,n_owners:long,n_repos:long,n_texts:long>>"


def entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def opaque(s: str) -> bool:
    return any(c.isdigit() for c in s) and any(c.isalpha() for c in s) and entropy(s) >= MIN_ENTROPY


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind, hash of the value) of every base span and of every other opaque string."""
    out = [(*m.span(), 0, m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(*m.span(), 1, m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(*m.span(), 2, m[0]) for m in HEX.finditer(text)]
    base = sorted((a, b) for a, b, _, _ in out)
    for m in OPAQUE.finditer(text):
        if not any(a < m.end() and m.start() < b for a, b in base) and opaque(m[0]):
            out.append((*m.span(), 3, m[0]))
    return sorted((a, b, k, hashlib.md5(v.encode()).hexdigest()) for a, b, k, v in out)


def _scan(batches):
    for batch in batches:
        text = pc.fill_null(batch["text"], "")
        hit = set(pc.indices_nonzero(pc.match_substring_regex(text, MAYBE)).to_pylist())
        spans = [[{"start": a, "end": b, "kind": k, "value": v} for a, b, k, v in candidates(text[i].as_py())] if i in hit else [] for i in range(len(text))]
        yield pa.record_batch({**{c: batch[c] for c in batch.schema.names if c != "text"},
                               "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("value", pa.string())])))})


def ownership(found: DataFrame) -> DataFrame:
    """(value, owner, repository, text_key) candidates -> value, n_owners, n_repos, n_texts. Repeats are merged before they
    travel; a text that stands in two repositories counts in both."""
    seen = found.select("value", "owner", "repository", "text_key").distinct()
    repos = seen.groupBy("value", "owner", "repository").agg(F.count("*").alias("texts"))
    owners = repos.groupBy("value", "owner").agg(F.count("*").alias("repos"), F.sum("texts").alias("texts"))
    return owners.groupBy("value").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("texts").alias("n_texts"))


def scan(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS, max_texts: int = MAX_TEXTS) -> DataFrame:
    """row_key, doc_id and spans (start, end, kind, live, n_owners, n_repos, n_texts) of each row; a row without any has an
    empty list."""
    owner = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))
    repo = F.concat_ws("/", owner, F.coalesce(F.concat(F.lit("="), "lang"), F.lit("null")))
    rows = docs.select("doc_id", "text", owner.alias("owner"), repo.alias("repository"), F.xxhash64("doc_id", "text", "source", "lang").alias("row_key"), F.xxhash64("text").alias("text_key"))
    rows = settle(rows.mapInArrow(_scan, f"doc_id long, owner string, repository string, row_key long, text_key long, spans {SPAN}"))
    each = rows.where(F.size("spans") > 0).select("doc_id", "row_key", "owner", "repository", "text_key", F.explode("spans").alias("s"))
    each = each.select("doc_id", "row_key", "owner", "repository", "text_key", "s.start", "s.end", "s.kind", "s.value").distinct()
    few = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos) & (F.col("n_texts") <= max_texts)
    judged = each.join(ownership(each), "value").withColumn("live", few)
    spans = judged.where("kind < 3 or live").groupBy("doc_id", "row_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live", "n_owners", "n_repos", "n_texts"))).alias("spans"))
    none = F.array().cast(JUDGED)
    full = rows.where(F.size("spans") > 0).select("doc_id", "row_key")
    spans = spans.withColumnRenamed("doc_id", "of_doc").withColumnRenamed("row_key", "of_row")
    same = (F.col("row_key") == F.col("of_row")) & F.col("doc_id").eqNullSafe(F.col("of_doc"))
    return (full.join(spans, same, "left").select("doc_id", "row_key", F.coalesce("spans", none).alias("spans"))
            .union(rows.where(F.size("spans") == 0).select("doc_id", "row_key", none)))


def redact(docs: DataFrame, max_owners: int = MAX_OWNERS) -> DataFrame:
    """The documents with every live-looking secret replaced by a mark; copied examples and clean documents stay as
    they are. n_chars, where there is one, follows the text."""
    found = scan(docs, max_owners).where(F.exists("spans", lambda s: s["live"])).select(
        F.col("row_key").alias("found_key"), F.filter("spans", lambda s: s["live"]).alias("live_spans")).dropDuplicates(["found_key"])
    key = F.xxhash64("doc_id", "text", "source", "lang")
    names = docs.columns
    rows = docs.select(F.struct(*[f"`{c}`" for c in names]).alias("d"), key.alias("found_key")).join(found, "found_key", "left")
    text = F.col("d.text")
    merged = F.aggregate(  # left to right: what is kept so far and where the next piece starts
        "live_spans", F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(F.struct(
            F.concat(a["kept"], F.when(s["start"] >= a["at"], F.concat(F.substr(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(MASK))).otherwise(F.lit(""))).alias("kept"),
            s["end"].alias("at"))))
    rows = rows.withColumn("m", F.when(F.col("live_spans").isNotNull(), merged))
    new = F.when(F.col("m").isNull(), text).otherwise(F.concat("m.kept", F.substr(text, (F.col("m.at") + 1).cast("int"), F.length(text))))
    rows = rows.withColumn("new", new)
    put = {"text": F.col("new"), "n_chars": F.when(F.col("m").isNull(), F.col("d.n_chars") if "n_chars" in names else F.lit(None)).otherwise(F.length("new")).cast("long")}
    return rows.select([put[c].alias(c) if c in put else F.col(f"d.`{c}`").alias(c) for c in names])


def op4(spark, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents"))
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    as_text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    seen = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["n_owners"], s["n_repos"], s["n_texts"])), ",")
    count = lambda f: F.size(F.filter("spans", f)).cast("long")
    of_kind = lambda k: lambda s: s["kind"] == k
    return found.select("doc_id", *[count(of_kind(k)).alias(f"n_{KINDS[k]}") for k in range(3)],
                        F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"),
                        count(lambda s: s["live"]).alias("n_live"), count(lambda s: ~s["live"]).alias("n_example"),
                        seen.alias("owners_repos_texts"))
