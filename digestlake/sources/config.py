"""Catalogues of queries, accounts and destinations from parsed YAML or JSON, and whole text files."""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    label: str
    query: str
    count: int
    product: str


def load(path: str) -> dict:
    """A mapping from a YAML or JSON file; YAML needs PyYAML."""
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            return json.load(f) or {}
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError(f"{path} needs PyYAML") from e
        return yaml.safe_load(f) or {}


def queries(catalogue: dict | None = None, accounts: dict | None = None, extra: list[str] = (), count: int = 100, product: str = "Top") -> list[Query]:
    """Keyword queries, queries given by hand and one for each account, with defaults filled in; none at all is an error."""
    out = []
    defaults = {"count": count, "product": product} | ((catalogue or {}).get("defaults") or {})
    for q in (catalogue or {}).get("queries") or []:
        out.append(Query(q.get("label") or q["query"][:40], q["query"], int(q.get("count", defaults["count"])), q.get("product", defaults["product"])))
    out += [Query(q[:40], q, count, product) for q in extra]
    each = int(((accounts or {}).get("defaults") or {}).get("count", count))
    for a in (accounts or {}).get("accounts") or []:
        handle, n = (a.get("handle"), int(a.get("count", each))) if isinstance(a, dict) else (a, each)
        if handle:
            out.append(Query(f"from:{handle}", f"from:{handle} -filter:replies", n, "Latest"))
    if not out:
        raise ValueError("no queries and no accounts")
    return out


def handles(accounts: dict | None) -> set[str]:
    """Lower-cased handles of an account list, whose members are mappings or names."""
    found = (a.get("handle") if isinstance(a, dict) else a for a in (accounts or {}).get("accounts") or [])
    return {str(h).lower() for h in found if h}


def expanded(value):
    """value with whole-string ${NAME} taken from the environment, missing names as empty."""
    if isinstance(value, dict):
        return {k: expanded(v) for k, v in value.items()}
    if isinstance(value, list):
        return [expanded(v) for v in value]
    m = re.fullmatch(r"\$\{(\w+)\}", value) if isinstance(value, str) else None
    return os.environ.get(m[1], "") if m else value


def table(spark: SparkSession, rows: list[Query]) -> DataFrame:
    return spark.createDataFrame([(q.label, q.query, q.count, q.product) for q in rows], "label string, query string, count long, product string")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole text files."""
    from pyspark.sql import functions as F

    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
