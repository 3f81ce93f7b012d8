"""Packing by non-negative least squares over the histogram of lengths.

A document is cut into full sequences and a rest. Rests fall into `classes` of lengths, a class standing for its largest length, so that classes that sum to
a whole sequence always fit in one. All combinations of at most `depth` classes with that sum are enumerated; least squares without negative counts say how often each
is repeated so that the histogram is used up, with the error of a class weighed by its length. Counts are rounded, and lowered where a class has fewer documents.

The histogram and the combinations are bounded by `classes` and `depth`; they are all that the driver sees. Documents are numbered within their class by the counts of the
input's slices, and a number decides the combination, its repetition and the place in it: a join with a table of ranges, so no class is gathered anywhere, however many documents share a length.

What no combination uses is packed greedily: laid end to end, these rests first fill the room that combinations leave, as their documents are shorter than their classes, and then
sequences of their own, cut where one is full. Two running sums, of tokens and of room, tell which tokens lie where. Repetitions are given up until the rests are about enough for the room.
What remains at the very end is cut at powers of two, which need no padding. So only rests are ever cut beside full sequences.

Defined results: a null or empty text is one piece that holds the end id alone; a null doc_id and repeated rows are documents of their own; texts of any length are cut whole;
an empty table gives no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored, text_or_empty
from .tokens import Encoder, batches_of_texts

RESTS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, class int, nth long, ids binary"
OUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
#: Numbers of slices and classes that go to every task; more of them are joined by sort and merge.
BROADCAST_ROWS = 200_000
#: Tokens of a stretch in which rests and room meet, and sequences whose room is summed by one task.
STRETCH = 4096
SLICE = 1 << 16


def rests(docs: DataFrame, tokenizer_path: str, capacity: int, classes: int, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The full sequences of every text (class 0) and its rest with its ids, numbered within its slice of the input and class. Stored."""
    grain = capacity // classes

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, part, seen = Encoder.of(tokenizer_path, end_id), TaskContext.get().partitionId(), [0] * (classes + 1)
        for batch in batches:
            texts = batch["text"].tolist()
            doc_ids = [None if pd.isna(x) else int(x) for x in batch["doc_id"]]
            for lo, hi in batches_of_texts(texts):
                ids, lengths = encoder.encode(texts[lo:hi])
                at, out = 0, []
                for doc_id, n in zip(doc_ids[lo:hi], lengths.tolist()):
                    for start in range(0, n, capacity):
                        size = min(capacity, n - start)
                        raw = np.ascontiguousarray(ids[at + start : at + start + size], "<u4").tobytes()
                        c = -(-size // grain) if size < capacity else 0
                        out.append((doc_id, start, size, zlib.crc32(raw), n, part, c, seen[c], raw if c else None))
                        seen[c] += 1
                    at += n
                yield pd.DataFrame(out, columns=[x.split()[0] for x in RESTS.split(", ")]).astype({"doc_id": "Int64"})

    return stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInPandas(cut, RESTS), "rests")


def combinations(total: int, depth: int, most: int | None = None) -> list[tuple[int, ...]]:
    """All non-increasing tuples of at most depth numbers, none above most, that sum to total."""
    most = min(total, most or total)
    out = [(total,)] if total <= most else []
    if depth > 1:
        for first in range(min(most, total - 1), 0, -1):
            if first * depth < total:
                break
            out += [(first, *rest) for rest in combinations(total - first, depth - 1, first)]
    return out


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by the active sets of Lawson and Hanson."""
    n = a.shape[1]
    x, used = np.zeros(n), np.zeros(n, bool)
    slope = a.T @ b
    enough = 1e-10 * max(1.0, np.abs(slope).max(initial=0))
    for _ in range(10 * n):
        open_ = np.where(used, -np.inf, slope)
        j = int(np.argmax(open_)) if n else 0
        if not n or open_[j] <= enough:
            break
        used[j] = True
        while True:
            s = np.zeros(n)
            s[used] = np.linalg.lstsq(a[:, used], b, rcond=None)[0]
            below = used & (s <= 0)
            if not below.any():
                break
            x += np.min(x[below] / (x[below] - s[below])) * (s - x)
            # a new column that cannot rise leaves again, and is not tried before another has changed the slope
            used &= x > 1e-12 * max(1.0, x.max())
            x[~used] = 0
            if not used.any():
                s = x
                break
        x = s
        slope = a.T @ (b - a @ x)
        if not used[j]:
            slope[j] = -np.inf
    return x


def mixture(counts: np.ndarray, tokens: np.ndarray, capacity: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """(classes, repeats) of the combinations, for the number and the tokens of the rests of each class 1 .. n (place 0 is unused)."""
    classes = len(counts) - 1
    some = [m for m in combinations(classes, depth) if all(counts[c] for c in m)]
    if not some:
        return []
    uses = np.zeros((classes + 1, len(some)))
    for k, m in enumerate(some):
        for c in m:
            uses[c, k] += 1
    weight = np.arange(classes + 1, dtype=float)
    x = np.rint(nnls(uses * weight[:, None], counts * weight)).astype(np.int64)
    mean = np.divide(tokens, counts, out=np.zeros(classes + 1), where=counts > 0)
    room = np.array([capacity - sum(mean[c] for c in m) for m in some])

    def fitted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, out = counts.astype(np.int64).copy(), np.zeros_like(x)
        for k in np.argsort(-x, kind="stable"):
            if x[k] > 0:
                need = uses[:, k].astype(np.int64)
                out[k] = min(x[k], int((left[need > 0] // need[need > 0]).min()))
                left -= out[k] * need
        return out, left

    out, left = fitted(x)
    for percent in range(1, 101):
        if not out.any() or float((left * mean).sum()) >= 1.02 * float((out * room).sum()):
            break
        out, left = fitted(x * (100 - percent) // 100)
    return [(some[k], int(out[k])) for k in np.flatnonzero(out)]


def _before(counts: DataFrame, by: list[str], order: str, n: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum(n).over(w), F.lit(0).cast("long"))).drop(n)


def placed(cut: DataFrame, counts: list[tuple[int, int, int]], capacity: int, classes: int, depth: int) -> tuple[DataFrame, int]:
    """The rests with sequence_id and place where a combination takes them, without ids there, and the number of sequences of combinations. Stored."""
    spark = cut.sparkSession
    number, tokens = np.zeros(classes + 1), np.zeros(classes + 1)
    for c, n, t in counts:
        number[c], tokens[c] = n, t
    ranges, first, sequences = [], [0] * (classes + 1), 0
    for m, repeats in mixture(number, tokens, capacity, depth):
        for place, c in enumerate(m):
            ranges.append((c, first[c], first[c] + repeats, sequences, place))
            first[c] += repeats
        sequences += repeats
    table = spark.createDataFrame(ranges, "of int, low long, high long, base long, place int")
    each = cut.where("class > 0")
    sums = stored(_before(each.groupBy("part", "class").agg(F.count(F.lit(1)).alias("n")), ["class"], "part", "n"), "slices")
    small = sums.count() <= BROADCAST_ROWS
    ranked = each.join(F.broadcast(sums) if small else sums.hint("merge"), ["part", "class"]).withColumn("rank", F.col("before") + F.col("nth"))
    # a row for each place of each combination with repeats, of which there are classes at most
    rows = ranked.join(F.broadcast(table), (F.col("class") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")), "left")
    sequence = F.col("base") + F.col("rank") - F.col("low")
    ids = F.when(F.col("base").isNull(), F.col("ids"))
    return stored(rows.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "class", "nth", ids.alias("ids"), sequence.alias("sequence_id"), "place"), "placed"), sequences


def _rooms(taken: DataFrame, capacity: int) -> DataFrame:
    """(sequence_id, at, begin, end) of the room in sequences of combinations, end to end in the order of their numbers."""
    rooms = taken.groupBy("sequence_id").agg(F.sum("length").alias("at")).where(F.col("at") < capacity).select("sequence_id", "at", (F.lit(capacity) - F.col("at")).alias("n"), F.expr(f"sequence_id div {SLICE}").alias("slice"))
    inside = Window.partitionBy("slice").orderBy("sequence_id")
    sums = _before(rooms.groupBy("slice").agg(F.sum("n").alias("n")), [], "slice", "n")
    return rooms.withColumn("end", F.sum("n").over(inside)).join(sums, "slice").select("sequence_id", "at", (F.col("before") + F.col("end") - F.col("n")).alias("begin"), (F.col("before") + F.col("end")).alias("end"))


def _tail(tokens: int) -> list[int]:
    """Powers of two that sum to tokens."""
    return [1 << b for b in reversed(range(tokens.bit_length())) if tokens >> b & 1]


def _greedy(left: DataFrame, rooms: DataFrame, capacity: int, sequences: int) -> DataFrame:
    """The rests without a place, laid end to end over the room and then over sequences of their own."""
    spark = left.sparkSession
    room = rooms.agg(F.max("end")).first()[0] or 0
    total = left.agg(F.sum("length")).first()[0] or 0
    own = max(0, total - room)
    full = own // capacity
    begin, ends = room + full * capacity, []
    for k, n in enumerate(_tail(own - full * capacity)):
        ends.append((sequences + full + k, 0, begin, begin + n))
        begin += n
    new = spark.range(full).select((F.col("id") + sequences).alias("sequence_id"), F.lit(0).cast("long").alias("at"), (F.lit(room) + F.col("id") * capacity).cast("long").alias("begin"), (F.lit(room) + (F.col("id") + 1) * capacity).cast("long").alias("end"))
    every = rooms.unionByName(new).unionByName(spark.createDataFrame(ends, "sequence_id long, at long, begin long, end long"))

    inside = Window.partitionBy("part").orderBy("class", "nth")
    sums = _before(left.groupBy("part").agg(F.sum("length").alias("n")), [], "part", "n")
    laid = left.withColumn("last", F.sum("length").over(inside)).join(sums, "part").withColumn("to", F.col("before") + F.col("last")).withColumn("from", F.col("to") - F.col("length"))
    met = lambda rows, a, b: rows.withColumn("stretch", F.explode(F.sequence(F.expr(f"{a} div {STRETCH}"), F.expr(f"({b} - 1) div {STRETCH}"))))
    both = met(laid, "`from`", "`to`").hint("merge").join(met(every.withColumnRenamed("sequence_id", "s"), "begin", "end"), "stretch")
    lo, hi = F.greatest("from", "begin"), F.least("to", "end")
    # rows that meet in two stretches count in that of their first common token
    cut = both.where((lo < hi) & (F.expr(f"greatest(`from`, begin) div {STRETCH}") == F.col("stretch"))).withColumn("lo", lo).withColumn("size", hi - lo)
    skip = F.col("lo") - F.col("from")
    ids = F.substring("ids", (skip * 4 + 1).cast("int"), (F.col("size") * 4).cast("int"))
    return cut.select("doc_id", (F.col("start") + skip).alias("start"), F.col("size").alias("length"), F.crc32(ids).alias("ids_crc32"), "doc_tokens", F.col("s").alias("sequence_id"), (F.col("at") + F.col("lo") - F.col("begin")).alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, classes: int = 64, depth: int = 4, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its sequence_id and offset."""
    if capacity % classes:
        raise ValueError("classes have equal widths")
    cut = rests(docs, tokenizer_path, capacity, classes, end_id, id_col, text_col)
    histogram = [(r["class"], r["n"], r["t"]) for r in cut.where("class > 0").groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("t")).collect()]
    rows, sequences = placed(cut, histogram, capacity, classes, depth)
    taken = rows.where("sequence_id is not null")
    before = F.sum("length").over(Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    in_place = taken.withColumn("offset", F.coalesce(before, F.lit(0).cast("long"))).select(*OUT)
    rest = _greedy(rows.where("sequence_id is null"), _rooms(taken, capacity), capacity, sequences)
    alone = cut.where("class = 0").withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return in_place.unionByName(rest).unionByName(alone.select(*OUT))
