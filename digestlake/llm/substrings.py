"""Suffix-array deduplication by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Every byte covered by a string of LENGTH bytes that also starts in a document with a smaller id is found, over whole texts.

1. Texts are stored once as files of bounded bytes in the shared folder, with a manifest; later passes read file by file, so texts are not shuffled. Copies of a
   whole text are found by SHA-256; only the first goes on.
2. Each window of LENGTH bytes has a minimizer, the least hash among its K-byte strings. Equal windows have equal
   minimizers, so a window can only repeat where its minimizer does. A file sends each minimizer once, and learns which occur in other files.
3. Around each shared minimizer, the bytes of the windows that belong to it form a chunk. A file sends each distinct
   chunk once, with the least id that has it, to the bucket of its minimizer. Chunks of one hash are compared byte by byte, in the file and in the bucket.
4. A bucket sorts the suffixes of its chunks to the depth needed, takes the transform, and expands
   intervals breadth-first by backward extension: boundaries where the common prefix is 0, 1, 2, .. long are derived
   in turn, and the expansion stops at LENGTH. Suffixes between boundaries share LENGTH bytes or more; the least id of
   each such class decides, and each file gets back one bit for each window.
5. Each file marks its bytes and gives the removed spans and what is kept; remove_repeats digests these.

A passage that a third of all documents share costs each file one chunk a minimizer. The number of buckets grows with the bytes of all texts and not with the
number of files; a file sends a blob to a bucket only if it has something for it, so there are never more blobs than minimizers. Buckets are worked
off in parts of bounded size. A document longer than FILE_BYTES is a file of its own.

Defined results: a null text is empty; a null id counts as larger than all others; rows that repeat an id are judged against smaller
ids only; texts under LENGTH bytes keep everything; very long texts are read whole; an empty table gives no rows. Extra columns are ignored, whatever their
names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesets import INVERSE, mix, powers, prefix_hashes, slices, span_hashes
from .shared import join_hot, stored, text_or_empty
from .textfiles import BLOBS, BUCKET_BYTES, blobs, by_bucket, digests_of, meet, meet_keys, over_files, read_texts, replies_by_file, rows_by_bucket, store_texts

LENGTH = 50
K = 24
NO_ID = (1 << 63) - 1
PART_BYTES = 1 << 19


# -- interval expansion ---------------------------------------------------------------------------


def suffix_order(symbols: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by their next depth symbols or more; left is the number of symbols up to the next separator, which is 0.

    The first sort takes as many symbols as fit into 64 bits; each later one joins the ranks of three stretches.
    """
    n = len(symbols)
    used, dense = np.unique(symbols, return_inverse=True)
    bits = max(1, int(len(used) - 1).bit_length())

    def joined(key: np.ndarray, stretch: int, times: int, width: int) -> np.ndarray:
        out = key
        for j in range(1, times):
            ahead = np.zeros(n, np.uint64)
            ahead[: max(0, n - j * stretch)] = key[j * stretch :]
            ahead[left <= j * stretch] = 0
            out = (out << np.uint64(width)) | ahead
        return out

    reach = 64 // bits
    key = joined(dense.astype(np.uint64), 1, reach, bits)
    width = int(n + 1).bit_length()
    while True:
        order = np.argsort(key)
        if reach >= depth:
            return order
        ranked = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[True], ranked[1:] != ranked[:-1]]), dtype=np.uint64)
        times = 3 if 3 * width <= 64 else 2
        key = joined(rank, reach, times, width)
        reach *= times


def class_starts(symbols: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """Where, in suffix order, the common prefix with the suffix before is shorter than least.

    Level by level: an interval whose right end was set at the last level is extended backward by each
    symbol that precedes it; the place after the extension's last suffix has a common prefix longer by one. Separators
    (symbol 0) differ from each other and are never extended over.
    """
    n = len(symbols)
    before = symbols[order - 1]  # the transform; the first place is preceded by a separator
    psi = np.argsort(before, kind="stable")
    forward = np.empty(n, np.int64)
    forward[psi] = np.arange(n)
    first = before[psi]  # the first symbol of each suffix in order
    known = np.zeros(n + 1, bool)
    known[n] = True
    head = np.empty(n, bool)
    head[0] = True
    head[1:] = first[1:] != first[:-1]
    head |= first == 0
    known[:n] = head
    fresh = np.flatnonzero(known)[1:]
    psi_to = np.concatenate([psi, [n]])
    for _ in range(1, least):
        if not len(fresh):
            break
        bounds = np.flatnonzero(known)
        lo = bounds[np.searchsorted(bounds, fresh) - 1]
        size = fresh - lo
        after = np.cumsum(size)
        at = np.repeat(lo - (after - size), size) + np.arange(after[-1])
        end = np.repeat(fresh, size)
        real = before[at] != 0
        at, end = at[real], end[real]
        p = forward[at] + 1
        fresh = p[(psi_to[p] >= end) & ~known[p]]  # each place once: p tells its suffix, and that its interval
        known[fresh] = True
    return known[:n]


def least_ids(chunks: list[bytes], ids: np.ndarray, least: int = LENGTH) -> list[np.ndarray]:
    """For each chunk, and each of its windows of so many bytes, the least id of a chunk that has the window."""
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
    text = np.frombuffer(b"".join(chunks), np.uint8)
    at = np.cumsum(sizes) - sizes
    place = np.arange(len(text)) + np.repeat(np.arange(len(chunks)), sizes)
    symbols = np.zeros(len(text) + len(chunks), np.int16)
    symbols[place] = text.astype(np.int16) + 1
    left = np.zeros(len(symbols), np.int64)
    left[place] = np.repeat(sizes + at, sizes) - np.arange(len(text))
    order = suffix_order(symbols, left, least)
    starts = np.flatnonzero(class_starts(symbols, order, least))
    owner = np.full(len(symbols), NO_ID, np.int64)
    owner[place] = np.repeat(ids, sizes)
    owner[left < least] = NO_ID
    smallest = np.minimum.reduceat(owner[order], starts)
    out = np.empty(len(symbols), np.int64)
    out[order] = np.repeat(smallest, np.diff(starts, append=len(order)))
    begin = at + np.arange(len(chunks))
    return [out[b : b + n - least + 1] for b, n in zip(begin.tolist(), sizes.tolist())]


# -- minimizers and chunks ------------------------------------------------------------------------


def chunks_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first window, last window, minimizer's hash, chunk's hash) of the runs of windows with one minimizer."""
    n, width = len(data), LENGTH - K + 1
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    sums = prefix_hashes(data)
    hashes = mix((sums[K:] - sums[:-K]) * powers(INVERSE, n + 1)[: n - K + 1])
    least = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    where = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)  # of each window
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(where)]
    inside = np.arange(len(where)) + LENGTH <= offsets[1:][row]
    windows = np.flatnonzero(inside)
    if not len(windows):
        return none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    where, row = where[windows], row[windows]
    head = np.concatenate([[True], (where[1:] != where[:-1]) | (row[1:] != row[:-1])])
    first = np.flatnonzero(head)
    last = np.concatenate([first[1:], [len(windows)]]) - 1
    lo, hi = windows[first], windows[last]
    return row[first], lo, hi, hashes[where[first]], span_hashes(sums, lo, hi + LENGTH)


def same_bytes(data: np.ndarray, one: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the size[i] bytes from one[i] on are those from other[i] on."""
    out = np.ones(len(one), bool)
    for lo in range(0, len(one), 20_000):
        n = size[lo : lo + 20_000]
        end = np.cumsum(n)
        step = np.arange(end[-1]) - np.repeat(end - n, n)
        equal = data[np.repeat(one[lo : lo + 20_000], n) + step] == data[np.repeat(other[lo : lo + 20_000], n) + step]
        out[lo : lo + 20_000] = np.logical_and.reduceat(equal, end - n)
    return out


def alike(data: np.ndarray, start: np.ndarray, size: np.ndarray, content: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of each group, group of each place in order) of places sorted by content: one hash and the same bytes. A place whose bytes differ from those of the first with its hash is a group of its own."""
    ordered = content[order]
    head = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    group = np.repeat(np.arange(len(head)), np.diff(head, append=len(order)))
    first = order[head]
    rest = np.flatnonzero(first[group] != order)
    a, b = order[rest], first[group[rest]]
    same = size[a] == size[b]
    same[same] = same_bytes(data, start[a[same]], start[b[same]], size[a[same]])
    odd = rest[~same]
    group[odd] = len(first) + np.arange(len(odd))
    return np.concatenate([first, order[odd]]), group


class File:
    """One stored file: ids, texts as bytes, and the chunks of the rows that are not copies."""

    def __init__(self, uri: str, copies: bytes | None):
        self.ids, self.data, self.offsets = read_texts(uri)
        self.copy = np.zeros(len(self.ids), bool)
        if copies:
            self.copy[np.frombuffer(copies, np.int64)] = True

    def chunks(self) -> None:
        """Sets row, lo (first window), more (windows after it), anchor, content of all chunks of the rows that are not copies."""
        found = []
        for a, b in slices(self.offsets):
            row, lo, hi, anchor, content = chunks_of(self.data[self.offsets[a] : self.offsets[b]], self.offsets[a : b + 1] - self.offsets[a])
            keep = ~self.copy[row + a]
            kind = np.int32 if len(self.data) < 1 << 31 else np.int64
            found.append([(row[keep] + a).astype(np.int32), (lo[keep] + self.offsets[a]).astype(kind), (hi[keep] - lo[keep]).astype(np.uint8), anchor[keep], content[keep]])
        columns = []
        for k, empty in enumerate((np.int32, np.int32, np.uint8, np.uint64, np.uint64)):
            columns.append(np.concatenate([f[k] for f in found]) if found else np.zeros(0, empty))
            for f in found:
                f[k] = None
        self.row, self.lo, self.more, self.anchor, self.content = columns

    def anchors(self, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(bucket, distinct minimizers, whether each is in two rows of this file or more)."""
        at = np.lexsort((self.row, self.anchor))
        anchor, row = self.anchor[at], self.row[at]
        head = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.zeros(0, np.int64)
        tail = np.append(head[1:], len(anchor)) - 1
        distinct, many = anchor[head], row[head] != row[tail] if len(head) else np.zeros(0, bool)
        for b, pick in by_bucket(distinct, buckets):
            yield b, distinct[pick], many[pick]

    def shared_chunks(self, buckets: int, replies: dict[int, bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """(bucket, one place of each distinct chunk whose minimizer occurs in other rows: that of the least id)."""
        shared = []
        for b, distinct, many in self.anchors(buckets):
            told = np.unpackbits(np.frombuffer(replies[b], np.uint8), count=len(distinct)).astype(bool) if b in replies else np.zeros(len(distinct), bool)
            shared.append(distinct[told | many])
        shared = np.sort(np.concatenate(shared)) if shared else np.zeros(0, np.uint64)
        if not len(shared):
            self.places = np.zeros(0, np.int64)
            return
        near = np.minimum(np.searchsorted(shared, self.anchor), len(shared) - 1)
        self.places = np.flatnonzero(shared[near] == self.anchor)
        ids, content = self.ids[self.row[self.places]], self.content[self.places]
        at = np.lexsort((self.places, ids, content))
        lo, size = self.lo[self.places].astype(np.int64), self.more[self.places].astype(np.int64) + LENGTH
        first, group = alike(self.data, lo, size, content, at)
        #: for each of places, the number of its chunk among the distinct ones
        self.of = np.empty(len(at), np.int64)
        self.of[at] = group
        self.first = self.places[first]
        yield from by_bucket(self.anchor[self.first], buckets)


def _over_files(files: DataFrame, n_files: int, work, schema: str) -> DataFrame:
    """work(file, texts and chunks, replies) -> batches, for each file."""

    def whole(row: dict) -> Iterator[pa.RecordBatch]:
        yield from work(row["file"], File(row["uri"], row.get("copies")), {x["bucket"]: x["data"] for x in row.get("replies") or ()})

    return over_files(files, n_files, whole, schema)


def _send_anchors(buckets: int):
    def work(number: int, file: File, _: dict) -> Iterator[pa.RecordBatch]:
        file.chunks()
        yield blobs([(number, b, distinct.astype("<u8").tobytes()) for b, distinct, _ in file.anchors(buckets)])

    return work


def _send_chunks(buckets: int):
    def work(number: int, file: File, replies: dict) -> Iterator[pa.RecordBatch]:
        file.chunks()
        for b, pick in file.shared_chunks(buckets, replies):
            at = file.first[pick]
            lo, size = file.lo[at].astype(np.int64), file.more[at].astype(np.int64) + LENGTH
            end = np.cumsum(size)
            body = file.data[np.repeat(lo - (end - size), size) + np.arange(end[-1])]
            head = np.array([len(at)], "<i8").tobytes() + file.ids[file.row[at]].astype("<i8").tobytes() + file.content[at].astype("<u8").tobytes() + size.astype("<u2").tobytes()
            yield blobs([(number, b, head + body.tobytes())])

    return work


KEPT = "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
#: Bytes of texts that a batch of results carries.
KEPT_BYTES = 4 << 20


def covered_by(starts: np.ndarray) -> np.ndarray:
    """Whether a window covers each byte: one that starts on it or less than LENGTH before. starts has a place more than there are bytes; windows end within their row."""
    covered, width = starts[:-1].copy(), 1
    while width < LENGTH:
        by = min(width, LENGTH - width)
        wider = covered.copy()
        wider[by:] |= covered[: max(0, len(covered) - by)]
        covered, width = wider, width + by
    return covered


def _finish(buckets: int):
    def work(number: int, file: File, replies: dict) -> Iterator[pa.RecordBatch]:
        told = {-1 - b: x for b, x in replies.items() if b < 0}
        file.chunks()
        masks: np.ndarray | None = None
        for b, pick in file.shared_chunks(buckets, {b: x for b, x in replies.items() if b >= 0}):
            masks = np.zeros(len(file.first), np.uint64) if masks is None else masks
            if b in told:
                masks[pick] = np.frombuffer(told[b], "<u8")
        starts = np.zeros(len(file.data) + 1, bool)
        if masks is not None:
            places, of = file.places, file.of
            everywhere = file.ids[file.row[places]] > file.ids[file.row[file.first]][of]
            mask = np.where(everywhere, np.uint64(0xFFFFFFFFFFFFFFFF), masks[of])
            lo, more = file.lo[places], file.more[places]
            for j in range(int(more.max(initial=0)) + 1):
                starts[lo[(j <= more) & ((mask >> np.uint64(j)) & np.uint64(1)).astype(bool)] + j] = True
            del places, of, everywhere, mask, lo, more
        # chunks have told what they can, and their columns are as large as what follows
        file.row = file.lo = file.more = file.anchor = file.content = file.places = file.of = file.first = masks = None
        covered = covered_by(starts)
        del starts
        rows, held = [], 0
        for k, (a, b) in enumerate(zip(file.offsets[:-1].tolist(), file.offsets[1:].tolist())):
            gone = covered[a:b]
            if file.copy[k]:
                gone = np.full(b - a, b - a >= LENGTH)
            edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            rows.append((int(file.ids[k]), b - a, edges, file.data[a:b][~gone].tobytes()))
            held += b - a
            if held > KEPT_BYTES:
                yield _kept(rows)
                rows, held = [], 0
        yield _kept(rows)

    return work


def _kept(rows: list[tuple[int, int, np.ndarray, bytes]]) -> pa.RecordBatch:
    edges = np.concatenate([r[2] for r in rows]) if rows else np.zeros((0, 2), np.int64)
    ends = np.cumsum([0] + [len(r[2]) for r in rows]).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(edges[:, 0], pa.int64()), pa.array(edges[:, 1], pa.int64())], fields=list(SPANS.value_type))
    columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), spans, type=SPANS), pa.array([r[3] for r in rows], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["id", "n_bytes", "spans", "kept"])


def meet_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each file's chunks, a mask each: the windows that a smaller id has. Replies have the bucket as -1 - bucket."""
    for bucket, held in rows_by_bucket(batches):
        ids, content, sizes, bodies = [], [], [], []
        for _, x in held:
            (n,) = np.frombuffer(x, "<i8", 1)
            ids.append(np.frombuffer(x, "<i8", n, 8))
            content.append(np.frombuffer(x, "<u8", n, 8 + 8 * n))
            sizes.append(np.frombuffer(x, "<u2", n, 8 + 16 * n).astype(np.int64))
            bodies.append(x[8 + 18 * n :])
        counts = [len(x) for x in ids]
        ids, content, size, body = np.concatenate(ids), np.concatenate(content), np.concatenate(sizes), b"".join(bodies)
        start, raw = np.cumsum(size) - size, np.frombuffer(body, np.uint8)
        masks = np.zeros(len(ids), np.uint64)
        full = (np.uint64(1) << (size - LENGTH + 1).astype(np.uint64)) - np.uint64(1)
        # chunks of one minimizer stay together: parts are cut by the minimizer, which is found again in the chunk
        group = _minimizer_of(body, start, size)
        parts = max(1, -(-len(body) // PART_BYTES))
        part = (mix(group) % np.uint64(parts)).astype(np.int64)
        for k in range(parts):
            mine = np.flatnonzero(part == k)
            if not len(mine):
                continue
            at = mine[np.lexsort((ids[mine], content[mine]))]
            one, of = alike(raw, start, size, content, at)
            # a minimizer with one distinct chunk has nothing to compare: the least id has all its windows
            _, same, many = np.unique(group[one], return_inverse=True, return_counts=True)
            alone = many[same] == 1
            masks[at[alone[of]]] = np.where(ids[one][of] < ids[at], full[at], np.uint64(0))[alone[of]]
            at, of = at[~alone[of]], (np.cumsum(~alone) - 1)[of[~alone[of]]]
            one = one[~alone]
            if not len(one):
                continue
            least = least_ids([body[a : a + n] for a, n in zip(start[one].tolist(), size[one].tolist())], ids[one])
            width = size[one] - LENGTH + 1
            table = np.full((len(one), int(width.max())), NO_ID, np.int64)
            table[np.arange(table.shape[1]) < width[:, None]] = np.concatenate(least)
            for j in range(table.shape[1]):
                masks[at] |= (table[of, j] < ids[at]).astype(np.uint64) << np.uint64(j)
        at, out = 0, []
        for (file, _), n in zip(held, counts):
            out.append((file, -1 - bucket, masks[at : at + n].astype("<u8").tobytes()))
            at += n
        yield blobs(out)


def _minimizer_of(body: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The minimizer's hash of each chunk: all windows of a chunk have the same, so the first tells."""
    data = np.frombuffer(body, np.uint8)
    out = np.empty(len(start), np.uint64)
    for lo in range(0, len(start), 20_000):
        a = start[lo : lo + 20_000]
        window = data[a[:, None] + np.arange(LENGTH)].reshape(-1)
        sums = prefix_hashes(window)
        hashes = mix((sums[K:] - sums[:-K]) * powers(INVERSE, len(window) + 1)[: len(window) - K + 1])
        hashes = np.concatenate([hashes, np.zeros(K - 1, np.uint64)]).reshape(len(a), LENGTH)[:, : LENGTH - K + 1]
        pick = np.argmin(hashes >> np.uint64(32), axis=1)
        out[lo : lo + 20_000] = hashes[np.arange(len(a)), pick]
    return out


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_a_file: int = 20_000) -> DataFrame:
    """(id, n_bytes, spans, kept) of every row of docs: the spans [start, end) of bytes that are removed, and the bytes that stay.

    A span may end inside a character, so what stays is binary.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), text_or_empty(text_col).alias("text"))
    manifest = store_texts(rows, rows_a_file)
    n, total, size = manifest.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    files = manifest.select("file", "uri").coalesce(1)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))

    digests = digests_of(manifest)
    several = stored(digests.groupBy("digest").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"), "digests")
    later = join_hot(digests, several, "digest", ["file", "row"], total, "inner").where("id > least").select("file", "row")

    def numbers(batches):
        for batch in batches:
            found = [(f, np.sort(np.array(r, np.int64)).tobytes()) for f, r in zip(batch.column("file").to_pylist(), batch.column("rows").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in found], pa.int64()), pa.array([x for _, x in found], pa.binary())], names=["file", "copies"])

    copies = later.groupBy("file").agg(F.collect_list("row").alias("rows")).mapInArrow(numbers, "file long, copies binary")
    files = stored(files.join(copies, "file", "left"), "files")

    told = stored(replies_by_file(meet(_over_files(files, n, _send_anchors(buckets), BLOBS), buckets, meet_keys("<u8"))), "minimizers")
    known = files.join(told, "file", "left")
    masks = meet(_over_files(known, n, _send_chunks(buckets), BLOBS), buckets, meet_chunks)
    both = known.join(replies_by_file(masks).withColumnRenamed("replies", "masks"), "file", "left")
    nothing = F.expr("cast(array() as array<struct<bucket:bigint,data:binary>>)")
    both = both.select("file", "uri", "copies", F.concat(F.coalesce("replies", nothing), F.coalesce("masks", nothing)).alias("replies"))
    done = _over_files(stored(both, "masks"), n, _finish(buckets), KEPT)
    return done.withColumn("id", F.when(F.col("id") != NO_ID, F.col("id")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_a_file: int = 20_000) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row of docs, from its spans and what is kept."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return deduplicated(docs, id_col, text_col, rows_a_file).select("id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
