"""Secret scanning over an incremental ledger of blobs.

Every version of every path is content-addressed (SHA-256 of its text). The ledger says which
pairs of blob and rule version were scanned before and what they held; a run scans each blob that
it has not seen under the present version of a rule once, whatever the number of paths that carry
it, appends to the ledger, and joins the findings back to all paths.

One carrier of each blob is read with its text: the least path, found by keys alone. Findings are joined back by blob, and a blob that very many
paths carry is dealt over several partitions.

Base rules are fixed; further rules add spans of other kinds of secrets and leave those of the base as they are. Spans are counted in code
points, end exclusive. Defined results: a null text is the empty text; a null doc_id is a path like others; repeated rows each get
their findings; very long texts are scanned whole; an empty table gives no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import join_hot, shared_dir, stored, text_or_empty

FINDING = "blob string, rule string, version int, start long, end long"
SEEN = "blob string, rules array<struct<rule:string,version:int>>"
SPANS = "array<struct<start:bigint,pos:int,end:bigint,rule:string>>"


@dataclass(frozen=True)
class Rule:
    """A pattern, the literals of which a text must hold one (compared in lower case), and the least length of a group."""

    name: str
    version: int
    pattern: str
    flags: int
    hints: tuple[str, ...]
    group: int
    least: int

    def spans(self, text: str, lowered: str, compiled: re.Pattern) -> list[tuple[int, int]]:
        if self.hints and not any(h in lowered for h in self.hints):
            return []
        return [m.span() for m in compiled.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


# The kinds in the order in which ties are listed.
RULES = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE, ("password", "passwd", "secret", "token", "apikey", "api_key"), 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", re.ASCII, ("akia",), 0, 16),
    # a maximal run of 32 or more: runs below that fail anyway
    Rule("hex", 1, r"[0-9a-f]{32,}", re.ASCII, (), 0, 32),
)
#: Kinds beyond the base, in patterns that need no look-around: keys in PEM, signed web tokens, tokens with a vendor's prefix, passwords in addresses.
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN (RSA |EC |DSA |OPENSSH |ENCRYPTED |PGP )?PRIVATE KEY( BLOCK)?-----[A-Za-z0-9+/=\s]*", re.ASCII, ("private key",), 0, 60),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", re.ASCII, ("eyj",), 0, 40),
    Rule("vendor", 1, r"(ghp_|gho_|ghs_|github_pat_|glpat-|xox[abpr]-|sk_live_|AIza)[A-Za-z0-9_-]+", re.ASCII, ("ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "xox", "sk_live_", "aiza"), 0, 20),
    Rule("url", 1, r"[a-z][a-z0-9+]*://[A-Za-z0-9._~%-]+:([A-Za-z0-9._~%!$&*+=-]+)@", re.ASCII, ("://",), 1, 4),
)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of blobs(blob, todo array<string>, text) under the rules named in todo; rows of one blob that follow each other count once."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = {r.name: (r, re.compile(r.pattern, r.flags)) for r in rules}
        last = None
        for batch in batches:
            found = []
            for blob, todo, text in zip(batch["blob"], batch["todo"], batch["text"]):
                if blob == last:
                    continue
                last, lowered = blob, text.lower()
                for name in todo:
                    rule, pattern = compiled[name]
                    found += [(blob, name, rule.version, a, b) for a, b in rule.spans(text, lowered, pattern)]
            yield pd.DataFrame(found, columns=["blob", "rule", "version", "start", "end"])

    return blobs.mapInPandas(scan, FINDING)


def blob_of(text: Column) -> Column:
    return F.sha2(text, 256)


def versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("path"), blob_of(text).alias("blob"), text.alias("text"))


class Ledger:
    """Two append-only Parquet tables: what was scanned, a row for each blob and run, and findings."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or shared_dir(spark, "ledger")
        if path is None:
            self._append(spark.createDataFrame([], SEEN), "scanned")
            self._append(spark.createDataFrame([], FINDING), "findings")

    def _append(self, df: DataFrame, table: str) -> None:
        df.write.mode("append").parquet(f"{self.path}/{table}")

    def _seen(self) -> DataFrame:
        return self.spark.read.schema(SEEN).parquet(f"{self.path}/scanned")

    def scanned(self) -> DataFrame:
        """(blob, rule, version) of all that was scanned."""
        return self._seen().select("blob", F.explode("rules").alias("r")).select("blob", "r.rule", "r.version")

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """The distinct findings of the present versions of rules."""
        version = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.version)])
        every = self.spark.read.schema(FINDING).parquet(f"{self.path}/findings")
        return every.where(F.col("rule").isin([r.name for r in rules]) & (F.col("version") == version[F.col("rule")])).distinct()

    def update(self, rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scans what is unseen among versions(path, blob, text); (blob, path, n) of the blobs, n being how many rows carry one.

        Findings are appended before the pairs are marked as scanned, so a run that dies in between scans
        again, and duplicate findings of such a run are dropped on reading.
        """
        carried = stored(rows.groupBy("blob").agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("n")), "ledger-blobs")
        current = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
        seen = self._seen().groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
        unseen = carried.join(seen, "blob", "left").select("blob", "path", F.when(F.col("seen").isNull(), current).otherwise(F.array_except(current, F.col("seen"))).alias("rules"))
        todo = stored(unseen.where(F.size("rules") > 0), "ledger-todo")
        wanted = todo.select(F.col("blob").alias("todo_blob"), F.col("path").alias("todo_path"), F.transform("rules", lambda r: r["rule"]).alias("todo"))
        # by blob and path, so that the many other carriers of a blob are dealt over all partitions
        texts = rows.join(wanted, F.col("blob").eqNullSafe(F.col("todo_blob")) & F.col("path").eqNullSafe(F.col("todo_path")))
        self._append(scan_blobs(texts.select("blob", "todo", "text"), rules), "findings")
        self._append(todo.select("blob", "rules"), "scanned")
        return carried


def spans_of(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """(blob, n, spans) of the blobs with findings, after the ledger was brought up to date, and the number of rows of docs."""
    carried = ledger.update(versions(docs, id_col, text_col), rules)
    rank = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)])
    by_blob = ledger.findings(rules).groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", rank[F.col("rule")].alias("pos"), "end", "rule"))).alias("spans"))
    total = carried.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return stored(carried.select("blob", "n").join(by_blob, "blob"), "spans"), total


def scan(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(path, blob, spans array<struct<start, pos, end, rule>>) of every row, by start and then rule; spans is null without findings."""
    found, total = spans_of(docs, ledger, rules, id_col, text_col)
    return join_hot(versions(docs, id_col, text_col).select("path", "blob"), found, "blob", ["path"], total).select("path", "blob", "spans")
