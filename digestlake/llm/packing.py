"""Best-fit packing of token sequences, improved by a swap-based local search.

Documents longer than a sequence are cut into full pieces and a rest. Pieces are numbered where they are stored, and dealt by a hash of
that number into groups of bounded size, so that equal ones spread like others; each group starts from best-fit decreasing and then exchanges documents between its underfull
sequences: one moves, one is swapped for one, or two for one, always from the emptier sequence to the fuller one, so that the sum of
squared fills grows and the emptiest sequences run empty. What stays underfull in the groups is packed once
more in larger groups, so that the groups' borders cost next to nothing.

Defined results: a null or empty text is one piece that holds the end id alone; a null doc_id and repeated rows
are documents of their own; texts of any length are cut whole; an empty table gives no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import release, stored, text_or_empty
from .tokens import Encoder, batches_of_texts

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
GROUP_PIECES = 20_000


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", keep_words: bool = True) -> DataFrame:
    """The pieces of every text: at most capacity ids each, only the last one shorter. With keep_words, workers keep the words' ids for their next task."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder.of(tokenizer_path, end_id)
        for batch in batches:
            texts, out = batch["text"].tolist(), []
            doc_ids = [None if pd.isna(x) else int(x) for x in batch["doc_id"]]
            for lo, hi in batches_of_texts(texts):
                ids, lengths = encoder.encode(texts[lo:hi])
                at = 0
                for doc_id, n in zip(doc_ids[lo:hi], lengths.tolist()):
                    for piece, start in enumerate(range(0, n, capacity)):
                        size = min(capacity, n - start)
                        out.append((doc_id, piece, start, size, zlib.crc32(np.ascontiguousarray(ids[at + start : at + start + size], "<u4"))))
                    at += n
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.astype({"doc_id": "Int64"})
        if not keep_words:
            release()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInPandas(cut, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece goes to the fullest sequence that still takes it."""
    order = np.argsort(-lengths, kind="stable")
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms: list[int] = []  # sorted, those of which a bin is open
    bins: list[list[int]] = []
    for k in order.tolist():
        size = int(lengths[k])
        i = bisect_left(rooms, size)
        if i == len(rooms):
            b, room = len(bins), capacity
            bins.append([])
        else:
            room = rooms[i]
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms.pop(i)
        bins[b].append(k)
        room -= size
        if room:
            if not open_bins[room]:
                rooms.insert(bisect_left(rooms, room), room)
            open_bins[room].append(b)
    return bins


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Exchanges between underfull bins until none is left that raises the sum of squared fills, or no bin can be saved; empty bins go.

    An exchange takes one or two documents out of a bin and gives them to a bin that is as full or fuller, for a shorter document of that bin or for nothing.
    All documents, and all pairs, by their sizes, are tried against all documents of the other bins; the exchange that leaves
    the least room in the fuller bin is made. The sum of squares is a whole number that rises with each, so the search ends.
    """
    bins = [list(b) for b in bins if b]
    fill = np.array([lengths[b].sum() for b in bins], np.int64)
    least = -(-int(fill.sum()) // capacity)
    open_bins = np.flatnonzero(fill < capacity)
    # what can be taken in exchange: the documents of underfull bins, and of each such bin nothing
    doc = np.array([k for b in open_bins for k in bins[b]] + [-1] * len(open_bins), np.int64)
    home = np.concatenate([np.repeat(open_bins, [len(bins[b]) for b in open_bins]), open_bins]).astype(np.int64)
    place = {int(k): i for i, k in enumerate(doc) if k >= 0}
    size = np.where(doc >= 0, lengths[doc], 0)
    left = len(bins)
    changed = True
    while changed and left > least:
        changed = False
        for b in sorted(open_bins.tolist(), key=lambda b: fill[b]):
            while 0 < fill[b] < capacity and left > least:
                given, docs_given = _sums(bins[b], lengths)
                limit = size + capacity - fill[home]
                best = np.searchsorted(given, limit, "right") - 1
                able = np.flatnonzero((best >= 0) & (given[best] > size) & (home != b) & (fill[home] >= fill[b]))
                if not len(able):
                    break
                i = int(able[np.argmin(limit[able] - given[best[able]])])
                a, y, out = int(home[i]), int(given[best[i]]), docs_given[best[i]]
                bins[b] = [k for k in bins[b] if k not in out]
                if doc[i] >= 0:
                    bins[a].remove(int(doc[i]))
                    bins[b].append(int(doc[i]))
                    home[i] = b
                bins[a] += out
                for k in out:
                    home[place[k]] = a
                fill[a] += y - size[i]
                fill[b] += size[i] - y
                changed = True
                left -= fill[b] == 0
    return [b for b in bins if b]


def _sums(members: list[int], lengths: np.ndarray) -> tuple[np.ndarray, list[tuple[int, ...]]]:
    """The distinct sizes of one or two of the members, rising, and for each the members; one is taken before two."""
    one, two = {}, {}
    for k in members:
        n = int(lengths[k])
        if n in one:
            two.setdefault(n, k)
        else:
            one[n] = k
    sums = {n: (k,) for n, k in one.items()}
    sizes = list(one)
    for i, m in enumerate(sizes):
        if m in two:
            sums.setdefault(2 * m, (one[m], two[m]))
        for n in sizes[i + 1 :]:
            sums.setdefault(m + n, (one[m], one[n]))
    order = sorted(sums)
    return np.array(order, np.int64), [sums[n] for n in order]


def pack_group(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    return local_search(best_fit(lengths, capacity), lengths, capacity)


#: Pieces with the number that each gets where it is stored, by which equal rows are told apart.
NUMBERED = PIECES + ", row long"
PACKED = NUMBERED + ", round int, pack_group long, bin long, offset long, underfull boolean"


def _packed(rows: DataFrame, n_groups: int, capacity: int, number: int) -> DataFrame:
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32", "row"], kind="stable", ignore_index=True)
        lengths = frame["length"].to_numpy(np.int64)
        bins = pack_group(lengths, capacity)
        at = np.empty(len(frame), np.int64)
        offset, underfull = np.empty(len(frame), np.int64), np.empty(len(frame), bool)
        for b, members in enumerate(bins):
            size = lengths[members]
            at[members], offset[members], underfull[members] = b, np.cumsum(size) - size, size.sum() < capacity
        return frame.assign(round=number, bin=at, offset=offset, underfull=underfull)[[c.split()[0] for c in PACKED.split(", ")]]

    spread = F.pmod(F.xxhash64("row", F.lit(number)), F.lit(n_groups))
    return rows.withColumn("pack_group", spread).groupBy("pack_group").applyInPandas(pack, PACKED)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", keep_words: bool = True) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    cut = stored(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, keep_words).withColumn("row", F.monotonically_increasing_id()), "pieces")
    full = cut.where(F.col("length") >= capacity)
    rest = cut.where(F.col("length") < capacity)
    n = rest.count()
    first = stored(_packed(rest, max(1, n // GROUP_PIECES), capacity, 1), "packed")
    columns = [c.split()[0] for c in PIECES.split(", ")]
    again = first.where("underfull").select(*columns, "row")
    n_again = again.count()
    second = _packed(again, max(1, n_again // GROUP_PIECES), capacity, 2)
    both = first.where("not underfull").unionByName(second)
    # the round, group and bin as one number
    packed = both.select(*columns, (F.col("pack_group") * (4 * GROUP_PIECES * 16) + F.col("bin") * 4 + F.col("round")).alias("sequence_id"), "offset")
    alone = full.select(*columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)
