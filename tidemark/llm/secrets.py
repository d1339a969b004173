"""Secret scans over an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its text.  The
ledger, a folder of Parquet batches, holds one row for each scan of a blob:
which rule versions were run, and the spans found.  A scan run hashes the
versions, looks up which (blob, rule version) pairs the ledger lacks, reads
the text of one version of each such blob, runs just the missing rules on it,
appends a batch, and joins the findings back to all paths and versions.
Running again with nothing new reads no text but to hash it; a changed rule
(with its version raised) scans every blob for that rule alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table, text_of
from tidemark.session import fresh_path


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches are findings; with ``group``, that group must be ``least`` long."""
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base kinds, in this order.
BASE = (
    Rule("assign", 1, r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
RULES = BASE + (
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("jwt", 1, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("userinfo", 2, r"://[^\s/:@\"']++:[^\s/:@\"']{3,}+@"),
    Rule("prefixed", 2, r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})"),
)
#: Text that has to occur for a rule to match, to pass over most texts quickly.
NEEDS = {"access": "AKIA", "pem": "-----BEGIN ", "jwt": "eyJ", "userinfo": "://"}
LEDGER = "blob binary, rules array<string>, spans array<struct<kind:string,start:int,end:int>>"


def find(text: str, rules: Sequence[Rule]) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive; leftmost non-overlapping per rule."""
    out = []
    for r in rules:
        if r.kind in NEEDS and NEEDS[r.kind] not in text:
            continue
        for m in re.finditer(r.pattern, text):  # re keeps compiled patterns
            if len(m[r.group]) >= r.least:
                out.append((r.kind, m.start(), m.end()))
    return out


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """All batches of the ledger; an empty one if the folder isn't there yet."""
    try:
        return spark.read.schema(LEDGER).parquet(folder)
    except AnalysisException:
        return spark.createDataFrame([], LEDGER)


def missing_pairs(versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, key, todo): the rule versions not yet run on each blob, and one version's key to read it by."""
    names = [r.name for r in rules]
    done = ledger.select("blob", F.explode("rules").alias("rule")).where(F.col("rule").isin(names)) \
        .groupBy("blob").agg(F.collect_set("rule").alias("done"))  # at most one entry a rule
    blobs = versions.groupBy("blob").agg(F.min("key").alias("key"))
    wanted = F.array(*[F.lit(n) for n in names])
    return (blobs.join(done, "blob", "left")
            .select("blob", "key", F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>"))).alias("todo"))
            .where(F.size("todo") > 0))


def scan(docs: DataFrame, ledger_folder: str, *, rules: Sequence[Rule] = RULES, id_cols: Sequence[str] = ("doc_id",),
         text_col: str = "text") -> DataFrame:
    """Bring the ledger up to date with ``docs`` and return the findings of each of its rows.

    ``id_cols`` name a version (a path, or a path and a revision).  Returns
    them, blob (the address) and spans, array<struct<kind, start, end>>, sorted
    by start and then by the order of the rules.

    A null text counts as empty.  Null ids stay as they are.  Repeated rows get
    equal findings, one row each; equal texts share one blob, scanned once.
    An empty table gives no rows and appends nothing.  Other columns are
    ignored, whatever their names.
    """
    spark = docs.sparkSession
    by_name = {r.name: r for r in rules}
    ids = [F.col(c) for c in id_cols]
    rows = docs.select(F.struct(*ids).alias("key"), F.unhex(F.sha2(text_of(text_col).cast("binary"), 256)).alias("blob"))
    versions = staged(rows, "blob-versions")
    todo = staged(missing_pairs(versions, read_ledger(spark, ledger_folder), rules), "blob-todo")

    texts = docs.select(F.struct(*ids).alias("key"), text_of(text_col).alias("text"))
    # The wanted side is hashed: texts are dealt out once, unsorted.
    wanted = todo.hint("shuffle_hash")
    unread = texts.join(wanted, texts["key"].eqNullSafe(wanted["key"]), "inner") \
        .where(F.unhex(F.sha2(texts["text"].cast("binary"), 256)) == F.col("blob")).select("blob", "todo", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t, [by_name[n] for n in names])]
                     for t, names in zip(b["text"], b["todo"])]
            yield pd.DataFrame({"blob": b["blob"], "rules": b["todo"], "spans": spans})

    unread.mapInPandas(run, LEDGER).write.mode("append").parquet(ledger_folder)

    order = F.array(*[F.lit(r.kind) for r in rules])
    current = F.array(*[F.lit(r.name) for r in rules])
    kept = F.filter("spans", lambda s: F.array_contains(order, s["kind"]))
    # A blob has a row for each scan; findings of superseded rule versions are left out.
    found = (read_ledger(spark, ledger_folder)
             .where(F.size(F.array_intersect("rules", current)) > 0)
             .withColumn("kinds", F.transform(F.array_intersect("rules", current), lambda r: F.substring_index(r, "@", 1)))
             .select("blob", F.explode(F.filter(kept, lambda s: F.array_contains(F.col("kinds"), s["kind"]))).alias("s"))
             .groupBy("blob").agg(F.collect_set(F.struct(
                 F.col("s.start").alias("start"), F.array_position(order, F.col("s.kind")).alias("nth"),
                 F.col("s.end").alias("end"), F.col("s.kind").alias("kind"))).alias("got"))
             .select("blob", F.transform(F.sort_array("got"), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                                                                s["end"].alias("end"))).alias("spans")))
    found = staged(found, "blob-findings")
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return versions.join(found, "blob", "left").select("key.*", "blob", F.coalesce("spans", none).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def op1_blob_ledger_secrets(spark, sf_dir: str) -> DataFrame:
    """A first scan, into a ledger of its own."""
    found = scan(table(spark, sf_dir, "documents"), fresh_path(spark, "secret-ledger"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
