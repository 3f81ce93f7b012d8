"""Benchmark decontamination by an inverted index of the test items with block-max WAND.

Items are the documents of a BM25 index; every passage of every text is a query. Passages are overlapping word windows, twice as long as
the longest item and half of that apart, so that each item that occurs in a text is whole in one of them. An item's
scores are divided by the score that it gives itself, so one threshold holds for all.

Passages are queried in arrays. The commonest terms, which cannot reach a set share of the threshold in any item together, are set
aside; a passage whose other terms cannot make up the rest by their upper bounds is skipped. The others go through block-max WAND, all of a slice in
step: passages whose bounds reach the threshold in no range of items go first; then a cursor for each term walks its postings in order of items; cursors are sorted by item, and the pivot is the first at which the bounds of the terms so far reach
the threshold. If the maxima of the blocks of postings that hold the pivot reach it too, the pivot is scored or the cursors before it move up to
it; if not, all of them skip to the end of the shortest block or the next cursor's item. What scores enough is verified: enough of the item's question and of its answer (its last
sentence) must be found in the passage as runs of three words.

The index is built in blocks of at most ITEMS_A_BLOCK items and about BYTES_A_BLOCK bytes of text, weighted by frequencies and lengths over all items, and
written to the shared folder. Documents are read once, whatever the number of blocks: a task holds the words of some texts and looks them up in block after block.

Words are runs of letters and digits in lower case, so that marks and case don't hide a copy. Defined results: null or empty texts
and items match nothing; a null doc_id stays null in the result; repeated rows match each; very long texts are read whole, passage by passage; empty
tables give no rows. leaks ignores extra columns and clean keeps them, whatever their names.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesets import BYTE, LOWER_WIDE, PLAIN, mix, prefix_hashes, slices, span_hashes, text_bytes, words
from .shared import KEPT, shared_dir, stored, text_or_empty

ITEMS_A_BLOCK = 20_000
BYTES_A_BLOCK = 32 << 20
POSTINGS = 16  # of which one block maximum is kept
RANGES = 64  # of items, of which each term's maximum is kept
GATHERED = 32 << 20  # bytes of texts that are looked up in a block of the index before the next one is loaded
ASIDE = 0.5
TABLE = BYTE[LOWER_WIDE]


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each row and at last their number)."""
    starts, ends, first = words(data, offsets, PLAIN)
    return (span_hashes(prefix_hashes(data, TABLE), starts, ends) if len(starts) else np.zeros(0, np.uint64)), first


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words."""
    out = h
    for k in range(1, n):
        out = mix(out[:-1]) + h[k:] if len(out) > 1 else out[:0]
    return mix(out)


def question_and_answer(text: str) -> int:
    """Where the last sentence begins; if it is all there is, three quarters on."""
    cuts = [m.end() for m in re.finditer(r"[.!?]\s+|\n+", text.strip())]
    return cuts[-1] if cuts else len(text.strip()) * 3 // 4


@dataclass
class Whole:
    """Of all items that have words: their number, mean and greatest length; and of a block's terms, sorted, the items among all that have them."""

    items: int
    mean: float
    longest: int
    terms: np.ndarray
    df: np.ndarray


@dataclass
class Index:
    """BM25 impacts of terms in items, each divided by the item's score for itself."""

    ids: np.ndarray
    terms: np.ndarray  # sorted
    begin: np.ndarray  # of each term's postings
    item: np.ndarray
    impact: np.ndarray
    place: np.ndarray  # of each posting, term * number of items + item, which rises
    bound: np.ndarray  # of each term, its largest impact
    block_end: np.ndarray  # of each block of postings, the place of its last one
    block_bound: np.ndarray  # and its largest impact
    range_bound: np.ndarray  # of each term, its largest impact in each range of items
    common: np.ndarray  # of each term, whether it is set aside
    aside: float  # what the terms set aside can add up to
    longest: int
    grams: list[int]  # words of a run that is looked for: three, or all of a shorter item
    questions: list[np.ndarray]
    answers: list[np.ndarray]

    @classmethod
    def build(cls, ids: list[int], texts: list[str], threshold: float, k1: float = 1.2, b: float = 0.75, whole: "Whole | None" = None) -> "Index | None":
        rows = []
        for i, text in zip(ids, texts):
            raw = (text or "").encode()
            h, _ = hashed_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            if len(h):
                head = np.frombuffer((text.strip()[: question_and_answer(text)]).encode(), np.uint8)
                q, _ = hashed_words(head, np.array([0, len(head)]))
                rows.append((i, h, len(q)))
        if not rows:
            return None
        lengths = np.array([len(h) for _, h, _ in rows])
        flat = np.concatenate([h for _, h, _ in rows])
        owner = np.repeat(np.arange(len(rows)), lengths)
        terms, code = np.unique(flat, return_inverse=True)
        pairs, tf = np.unique(code * len(rows) + owner, return_counts=True)
        term, item = pairs // len(rows), pairs % len(rows)
        if whole is None:
            whole = Whole(len(rows), float(lengths.mean()), int(lengths.max()), terms, np.bincount(term, minlength=len(terms)))
        df = whole.df[np.searchsorted(whole.terms, terms)]
        idf = np.log(1 + (whole.items - df + 0.5) / (df + 0.5))
        impact = idf[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[item] / whole.mean))
        impact /= np.bincount(item, impact, minlength=len(rows))[item]
        begin = np.searchsorted(term, np.arange(len(terms) + 1))
        bound = np.maximum.reduceat(impact, begin[:-1])
        nth = np.arange(len(term)) - begin[term]
        head = np.flatnonzero(nth % POSTINGS == 0)
        place = term * len(rows) + item
        block_end, block_bound = place[np.append(head[1:], len(term)) - 1], np.maximum.reduceat(impact, head)
        wide = -(-len(rows) // RANGES)
        range_bound = np.zeros((len(terms), -(-len(rows) // wide)), np.float32)
        np.maximum.at(range_bound, (term, item // wide), impact.astype(np.float32))
        # set terms aside by falling document frequency while no item can gather ASIDE of the threshold from them
        gathered, common, aside = np.zeros(len(rows)), np.zeros(len(terms), bool), 0.0
        for t in np.argsort(-df, kind="stable"):
            after = gathered.copy()
            after[item[begin[t] : begin[t + 1]]] += impact[begin[t] : begin[t + 1]]
            if after.max() > ASIDE * threshold:
                break
            gathered, common[t], aside = after, True, float(after.max())
        runs = [min(3, len(h)) for _, h, _ in rows]
        every = [grams(h, n) for (_, h, _), n in zip(rows, runs)]
        # the question's runs are those within it, the answer's all others; each has one at least
        cut = [max(1, min(q - n + 1, len(g) - 1)) if len(g) > 1 else 1 for (_, _, q), g, n in zip(rows, every, runs)]
        questions = [np.unique(g[:c]) for g, c in zip(every, cut)]
        answers = [np.unique(g[c:] if c < len(g) else g) for g, c in zip(every, cut)]
        return cls(np.array([i for i, _, _ in rows]), terms, begin, item, impact, place, bound, block_end, block_bound, range_bound, common, aside, whole.longest, runs, questions, answers)

    def filter_bits(self) -> np.ndarray:
        bits = np.zeros(1 << 18, bool)
        bits[(self.terms >> np.uint64(46)).astype(np.int64)] = True
        return bits


def _expand(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, place) of all places in the ranges."""
    size = end - begin
    after = np.cumsum(size)
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(len(which)) - np.repeat(after - size, size) + np.repeat(begin, size)


def wand(index: Index, passage: np.ndarray, term: np.ndarray, threshold: float, read: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, item, score) of all pairs that reach the threshold, from distinct pairs of passage and term in order of passage.

    read takes the number of postings that were scored.
    """
    n = len(index.ids)
    enough, sure = threshold - 1e-9, threshold - 1e-6  # bounds are compared with some room, as sums differ in their last digits
    if len(passage):
        # passages that reach it in no range of items are done with
        heads = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        live = (np.add.reduceat(index.range_bound[term], heads, axis=0) >= threshold - 1e-5).any(axis=1)
        keep = np.repeat(live, np.diff(heads, append=len(passage)))
        passage, term = passage[keep], term[keep]
    at, found = index.begin[term].copy(), []
    while len(passage):
        item = index.item[at]
        by = np.lexsort((item, passage))
        passage, term, at, item = passage[by], term[by], at[by], item[by]
        head = np.concatenate([[True], passage[1:] != passage[:-1]])
        start, which = np.flatnonzero(head), np.cumsum(head) - 1
        total = np.cumsum(index.bound[term])
        reached = total - np.concatenate([[0.0], total])[start][which] >= sure
        # the pivot of each passage: the first cursor by which the bounds reach the threshold
        first = np.full(len(start), len(passage))
        np.minimum.at(first, which[reached], np.flatnonzero(reached))
        some = first < len(passage)
        pivot = np.where(some, item[np.minimum(first, len(passage) - 1)], -1)
        lead = item <= pivot[which]
        block = np.searchsorted(index.block_end, term * n + pivot[which])
        inside = lead & (block < len(index.block_end))
        inside[inside] = index.block_end[block[inside]] // n == term[inside]
        held = np.where(inside, block, 0)
        most = np.bincount(which, np.where(inside, index.block_bound[held], 0.0), minlength=len(start))
        worth = some & (most >= sure)
        here = item[start] == pivot
        # scored: the pivot's postings, where all cursors up to it are on it
        score_now = worth & here
        mine = lead & score_now[which]
        if mine.any():
            score = np.bincount(which[mine], index.impact[at[mine]], minlength=len(start))
            ok = np.flatnonzero(score_now & (score >= enough))
            found.append((passage[start[ok]], pivot[ok], score[ok]))
            if read is not None:
                read.append(int(mine.sum()))
        # else the cursors go to the pivot, or beyond what no block maximum allows
        ends = np.where(inside, index.block_end[held] % n + 1, n)
        ends = np.where(lead, ends, item)
        skip = np.minimum.reduceat(ends, start)
        to = np.where(score_now, pivot + 1, np.where(worth, pivot, np.maximum(skip, pivot + 1)))
        moving = lead & (item < to[which])
        at[moving] = np.searchsorted(index.place, term[moving] * n + to[which][moving])
        keep = some[which] & (at < index.begin[term + 1])
        passage, term, at = passage[keep], term[keep], at[keep]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found))


def search(index: Index, bits: np.ndarray, h: np.ndarray, first: np.ndarray, threshold: float, overlap: float) -> list[tuple]:
    """(row, item, start word, score, question overlap, answer overlap) of verified passages, the best for each row and item."""
    half = index.longest
    # windows of the rows: [start, end) over the words of all rows
    counts = np.diff(first)
    n_windows = np.where(counts > 0, np.maximum(1, -(-(counts - half) // half)), 0)
    row = np.repeat(np.arange(len(counts)), n_windows)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    start = first[row] + nth * half
    end = np.minimum(start + 2 * half, first[row + 1])
    maybe = np.flatnonzero(bits[(h >> np.uint64(46)).astype(np.int64)])
    code = np.minimum(np.searchsorted(index.terms, h[maybe]), len(index.terms) - 1)
    hit = index.terms[code] == h[maybe]
    at, code = maybe[hit], code[hit]
    weight = np.where(index.common[code], 0.0, index.bound[code])
    sums = np.concatenate([[0.0], np.cumsum(weight)])
    lo, hi = np.searchsorted(at, start), np.searchsorted(at, end)
    able = np.flatnonzero(sums[hi] - sums[lo] + index.aside >= threshold - 1e-9)
    if not len(able):
        return []
    which, place = _expand(lo[able], hi[able])
    distinct = np.unique(which * len(index.terms) + code[place])
    # the same bound over distinct terms: those set aside count no more than they can add up to
    owner, term = distinct // len(index.terms), distinct % len(index.terms)
    rare = np.bincount(owner, np.where(index.common[term], 0, index.bound[term]), minlength=len(able))
    usual = np.bincount(owner, np.where(index.common[term], index.bound[term], 0), minlength=len(able))
    distinct = distinct[(rare + np.minimum(usual, index.aside) >= threshold - 1e-9)[owner]]
    passages, items, scores = wand(index, distinct // len(index.terms), distinct % len(index.terms), threshold)
    best: dict[tuple[int, int], tuple] = {}
    for p, i, s in zip(passages.tolist(), items.tolist(), scores.tolist()):
        w = int(able[p])
        have = np.unique(grams(h[start[w] : end[w]], index.grams[i]))
        share = lambda wanted: float(np.isin(wanted, have, assume_unique=True).mean())
        q, a = share(index.questions[i]), share(index.answers[i])
        if q >= overlap and a >= overlap:
            key, value = (int(row[w]), i), (float(s), q, a, int(start[w] - first[row[w]]))
            if key not in best or value[:3] > best[key][:3]:
                best[key] = value
    return [(r, i, v[3], *v[:3]) for (r, i), v in best.items()]


FOUND = "doc_id long, item_id long, start_word long, score double, question_overlap double, answer_overlap double"


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, overlap: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row for each pair of a text and a test item that it contains."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    uris = written(indices(benchmark, threshold, item_col, item_text_col), docs)

    def query(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        for batch, found in looked_up(batches, lambda b: b.column("text"), uris, threshold, overlap):
            doc_ids = batch.column("doc_id").to_pylist()
            columns = list(zip(*[(doc_ids[r], *rest) for r, *rest in found])) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in FOUND.split(", ")])

    return rows.mapInArrow(query, FOUND) if uris else docs.sparkSession.createDataFrame([], FOUND)


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, overlap: float = 0.5, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of docs that contain no test item, with all their columns; each is judged where it is read."""
    uris = written(indices(benchmark, threshold, item_col, item_text_col), docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in looked_up(batches, lambda b: b.column("doc").field(text_col), uris, threshold, overlap):
            keep = np.ones(batch.num_rows, bool)
            keep[[r for r, *_ in found]] = False
            yield batch.filter(pa.array(keep))

    whole = docs.select(F.struct("*").alias("doc"))
    return whole.mapInArrow(run, whole.schema).select("doc.*") if uris else docs


def written(blocks: Iterator[Index], docs: DataFrame) -> list[str]:
    """The blocks of the index as files in the shared folder."""
    from pyarrow.fs import FileSystem

    folder, uris = shared_dir(docs.sparkSession, "index"), []
    for index in blocks:
        fs, path = FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/{len(uris)}") as out:
            out.write(pickle.dumps(index, protocol=5))
        uris.append(f"{folder}/{len(uris)}")
    return uris


#: The block of the index that was loaded last.
_loaded: dict[str, tuple] = {}
KEPT.append(_loaded)


def load(uri: str) -> tuple[Index, np.ndarray]:
    if uri not in _loaded:
        from pyarrow.fs import FileSystem

        fs, path = FileSystem.from_uri(uri)
        with fs.open_input_stream(path) as file:
            index = pickle.loads(file.read())
        _loaded.clear()
        _loaded[uri] = index, index.filter_bits()
    return _loaded[uri]


def looked_up(batches: Iterator[pa.RecordBatch], text_of: Callable[[pa.RecordBatch], pa.Array], uris: list[str], threshold: float, overlap: float) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
    """(batch, [(row, item, start word, score, question overlap, answer overlap)]) of all batches, by all blocks of the index."""
    held: list[tuple] = []

    def out() -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
        found: list[list[tuple]] = [[] for _ in held]
        for uri in uris:
            index, bits = load(uri)
            for k, (_, parts) in enumerate(held):
                for lo, h, first in parts:
                    found[k] += [(lo + r, int(index.ids[i]), *rest) for r, i, *rest in search(index, bits, h, first, threshold, overlap)]
        yield from zip([batch for batch, _ in held], found)
        held.clear()

    size = 0
    for batch in batches:
        data, offsets = text_bytes(text_of(batch).fill_null(""))
        parts = [(lo, *hashed_words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])) for lo, hi in slices(offsets)]
        held.append((batch, parts))
        size += len(data)
        if len(uris) == 1 or size >= GATHERED:
            yield from out()
            size = 0
    yield from out()


WORDS = "term long, words long"


def _words(items: DataFrame) -> DataFrame:
    """Of each item with words its distinct terms, and a row (null, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                raw = text.encode()
                h, _ = hashed_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                if len(h):
                    terms = np.unique(h).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([*terms.tolist(), None], pa.int64()), pa.array([None] * len(terms) + [len(h)], pa.int64())], names=["term", "words"])

    return items.select("text").mapInArrow(run, WORDS)


def indices(benchmark: DataFrame, threshold: float, item_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """The index of each block of items, by document frequencies and lengths over all items. Items are dealt to blocks by hash, and stored by block."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), text_or_empty(text_col).alias("text"))
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n_blocks = max(-(-n // ITEMS_A_BLOCK), -(-size // BYTES_A_BLOCK))
    if n_blocks <= 1:
        blocks, several = [items] if n else [], False
    else:
        spark, path = benchmark.sparkSession, shared_dir(benchmark.sparkSession, "items")
        items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)).cast("int")).write.partitionBy("block").parquet(path)
        items = spark.read.schema("item long, text string, block int").parquet(path)
        blocks, several = [items.where(F.col("block") == k).select("item", "text") for k in range(n_blocks)], True
        words = stored(_words(items), "words")
        count, mean, longest = words.where("words is not null").agg(F.count("words"), F.avg("words"), F.max("words")).first()
        df = words.where("term is not null").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    for block in blocks:
        whole = None
        if several and count:
            own = df.join(_words(block).select("term").where("term is not null").distinct(), "term").toPandas()
            terms = own["term"].to_numpy(np.int64).view(np.uint64)
            at = np.argsort(terms)
            whole = Whole(count, mean, longest, terms[at], own["df"].to_numpy(np.int64)[at])
        rows = block.orderBy("item", "text").collect()
        index = Index.build([r["item"] for r in rows], [r["text"] for r in rows], threshold, whole=whole)
        if index is not None:
            yield index
