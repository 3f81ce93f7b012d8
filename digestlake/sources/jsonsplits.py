"""Records of large JSON files, read in byte ranges by many tasks.

A file holds an array of objects, or an object with such an array under a given name. A range that begins anywhere may begin inside a string, after a backslash, or between values, so each is summed up for all three
cases: the case that it ends in, how many brackets of before it closes and which it leaves open. Put together in the order of a file, the summaries tell every range the case and the brackets it begins with, and a second pass
gives the records that begin in it, whole, wherever they end. Both passes are array operations over bytes; texts are parsed by Spark.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

OUTSIDE, INSIDE, ESCAPED = range(3)
OPEN, CLOSE = b"{[", b"}]"
SPLIT_BYTES = 64 << 20
#: The name of the array in an envelope.
_NAME = "tweets"
#: What stands between the name of an array and its bracket may be as long as this.
NAME_BYTES = 512


@dataclass
class Scan:
    """Brackets outside strings of some bytes: their places, +1 or -1 each, and the case at the end."""

    at: np.ndarray
    step: np.ndarray
    kind: np.ndarray
    end: int


def scan(data: np.ndarray, case: int) -> Scan:
    """The brackets of data (uint8) if it begins in the given case."""
    n = len(data)
    # a backslash counts if the run of backslashes before it is even; what follows it is no mark
    slash = np.flatnonzero(data == 92)
    if case == ESCAPED and n and data[0] == 92:
        slash = slash[1:]
    run = np.arange(len(slash)) - np.maximum.accumulate(np.where(np.diff(slash, prepend=-2) > 1, np.arange(len(slash)), 0)) if len(slash) else slash
    marks = slash[run % 2 == 0]
    hidden = np.zeros(n + 1, bool)
    hidden[marks + 1] = True
    hidden[0] |= case == ESCAPED
    quote = np.flatnonzero((data == 34) & ~hidden[:n])
    place = np.flatnonzero((data == 123) | (data == 91) | (data == 125) | (data == 93))
    inside = (np.searchsorted(quote, place) + (case != OUTSIDE)) % 2 == 1
    place = place[~inside]
    kind = data[place]
    end = (len(quote) + (case != OUTSIDE)) % 2
    return Scan(place, np.where((kind == 123) | (kind == 91), 1, -1), kind, ESCAPED if end and n and hidden[n] else end)


def summary(data: np.ndarray, begin: int) -> list[dict]:
    """For each case that data may begin in: the case it ends in, the brackets of before that it closes, and those it leaves open, with their places in the file."""
    out = []
    for case in (OUTSIDE, INSIDE, ESCAPED):
        s = scan(data, case)
        depth = np.cumsum(s.step)
        closed = max(0, -int(depth.min())) if len(depth) else 0
        # an open bracket stays open if the depth never falls below it again
        later = np.minimum.accumulate(depth[::-1])[::-1] if len(depth) else depth
        left = (s.step > 0) & (depth <= later)
        out.append({"end": s.end, "closed": closed, "kinds": bytes(s.kind[left]).decode(), "places": (s.at[left] + begin).tolist()})
    return out


def _file(path: str):
    from pyarrow.fs import FileSystem, LocalFileSystem

    # the reader of listings writes file:/x where others write file:///x
    fs, name = (LocalFileSystem(), path[5:]) if path.startswith("file:") else FileSystem.from_uri(path)
    return fs.open_input_file(name)


def _read(file, begin: int, size: int) -> np.ndarray:
    return np.frombuffer(file.read_at(size, begin), np.uint8)


def _records(file, begin: int, size: int, length: int, case: int, stack: str, listed: bool) -> list[tuple[int, str]]:
    """(place, text) of the objects that begin in a range and are elements of the list; listed says whether the second bracket of the stack, if any, is that of the list."""
    data = _read(file, begin, size)
    s = scan(data, case)
    # brackets before each place: only the two outermost ones matter, so depth and their kinds are followed
    depth = len(stack) + np.concatenate([[0], np.cumsum(s.step)])
    starts, open_ = [], stack[:2]
    for k in np.flatnonzero((s.kind == 123) & (s.step > 0) & (depth[:-1] <= 2) | (depth[:-1] <= 2) & (s.kind != 123) | (depth[1:] <= 2)).tolist():
        here, now = int(depth[k]), chr(s.kind[k])
        if s.step[k] > 0:
            if now == "{" and (here == 1 and open_[0] == "[" or here == 2 and open_ == "{[" and listed):
                starts.append(int(s.at[k]))
            if here < 2:
                open_ = open_[:here] + now
                if here == 1 and now == "[":
                    listed = _named(file, begin + int(s.at[k]))
        else:
            open_ = open_[: here - 1]
    out = []
    more = data
    for at in starts:
        while True:
            rest = scan(more[at:], OUTSIDE)
            ends = np.flatnonzero(np.cumsum(rest.step) == 0)
            if len(ends):
                out.append((begin + at, more[at : at + int(rest.at[ends[0]]) + 1].tobytes().decode("utf-8", errors="replace")))
                break
            if begin + len(more) >= length:
                break  # the file ends within the record
            more = np.concatenate([more, _read(file, begin + len(more), max(1 << 16, len(more) - at))])
    return out


def _named(file, place: int) -> bool:
    """Whether the bracket at place belongs to the array of the given name."""
    size = min(place, NAME_BYTES)
    return re.search(rb'"' + _NAME.encode() + rb'"\s*:\s*$', file.read_at(size, place - size)) is not None


def records(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(file, at, value): the objects listed in JSON files, as text, with the byte they begin at. Elements that are no objects are left out, as is what follows a file's broken end."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length"))
    splits = files.where("length > 0").select("file", "length", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("nth", "begin"))
    sizes = files.agg(F.sum(F.ceil(F.col("length") / split_bytes))).first()[0] or 0
    ranges = splits.repartition(max(1, int(sizes)), "file", "nth")

    summed = "file string, length long, nth int, begin long, end array<int>, closed array<long>, kinds array<string>, places array<array<long>>"
    cut_ = "file string, at long, value string"
    to_arrow = lambda ddl: to_arrow_schema(StructType.fromDDL(ddl))
    summed_arrow, cut_arrow = to_arrow(summed), to_arrow(cut_)

    def sums(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with _file(row["file"]) as f:
                    found = summary(_read(f, row["begin"], min(split_bytes, row["length"] - row["begin"])), row["begin"])
                yield pa.RecordBatch.from_pylist([row | {k: [x[k] for x in found] for k in found[0]}], summed_arrow)

    def begun(frame: pd.DataFrame) -> pd.DataFrame:
        """The case and the outer brackets that each range of a file begins with."""
        frame = frame.sort_values("nth")
        case, stack, out = OUTSIDE, [], []
        with _file(frame["file"].iloc[0]) as f:
            for _, r in frame.iterrows():
                listed = len(stack) > 1 and stack[0][0] == "{" and stack[1][0] == "[" and _named(f, stack[1][1])
                out.append((r["file"], r["length"], r["begin"], case, "".join(k for k, _ in stack), listed))
                closed = int(r["closed"][case])
                stack = stack[: max(0, len(stack) - closed)] + list(zip(r["kinds"][case], [int(p) for p in r["places"][case]]))
                case = int(r["end"][case])
        return pd.DataFrame(out, columns=["file", "length", "begin", "case", "stack", "listed"])

    def cut(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with _file(row["file"]) as f:
                    rows = _records(f, row["begin"], min(split_bytes, row["length"] - row["begin"]), row["length"], row["case"], row["stack"], row["listed"])
                yield pa.RecordBatch.from_pylist([{"file": row["file"], "at": a, "value": v} for a, v in rows], cut_arrow)

    # a row for each range of a file, which are few; records are cut by as many tasks as there are ranges
    known = ranges.select("file", "length", "nth", "begin").mapInArrow(sums, summed).groupBy("file").applyInPandas(begun, "file string, length long, begin long, case int, stack string, listed boolean")
    return known.repartition(max(1, int(sizes)), "file", "begin").mapInArrow(cut, cut_)
