"""Texts stored once as files of bounded bytes, passes over the files, and exchanges of blobs between files and buckets of keys."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesets import mix, text_bytes
from .shared import shared_dir, stored

#: Bytes of texts in a file, and of all texts for each bucket.
FILE_BYTES = 32 << 20
BUCKET_BYTES = 128 << 20
#: Keys of a bucket that are compared at once.
PART_KEYS = 1 << 22
STORED = "file long, uri string, rows int, bytes long, ids binary, digests binary"


def store_texts(rows: DataFrame, rows_a_file: int, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes rows (id, text) to files of so many rows and bytes, one longer text being a file of its own, and gives the manifest: a row for each file.

    A task that runs again writes new files, and only those of the run that counts are in the manifest.
    """
    folder = shared_dir(rows.sparkSession, "texts")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSystem

        schema = pa.schema([("id", pa.int64()), ("text", pa.large_string())])
        number, held, n, size = TaskContext.get().partitionId() << 24, [], 0, 0

        def out() -> pa.RecordBatch:
            nonlocal number, n, size
            uri = f"{folder}/{number}-{uuid.uuid4().hex}.parquet"
            fs, path = FileSystem.from_uri(uri)
            fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
            table = pa.Table.from_batches([b for b, _ in held], schema)
            pq.write_table(table, path, filesystem=fs, compression="zstd", row_group_size=max(1, table.num_rows))
            digests = b"".join(d for _, d in held)
            row = [[number], [uri], [n], [size], [table["id"].to_numpy().astype("<i8").tobytes()], [digests]]
            held.clear()
            number, n, size = number + 1, 0, 0
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=[c.split()[0] for c in STORED.split(", ")])

        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            lo = 0
            while lo < batch.num_rows:
                # as many rows as the file still takes, one at least if it is empty
                hi = min(int(np.searchsorted(offsets, offsets[lo] + file_bytes - size, "right")) - 1, lo + rows_a_file - n, batch.num_rows)
                if hi <= lo and n:
                    yield out()
                    continue
                hi = max(hi, lo + 1)
                part = pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), batch.column("text").slice(lo, hi - lo).cast(pa.large_string())], schema=schema)
                held.append((part, b"".join(hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets[lo:hi], offsets[lo + 1 : hi + 1]))))
                n, size, lo = n + hi - lo, size + int(offsets[hi] - offsets[lo]), hi
        if n:
            yield out()

    return stored(rows.select("id", "text").mapInArrow(write, STORED), "manifest")


def digests_of(manifest: DataFrame) -> DataFrame:
    """(file, row, id, digest) of the stored rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n = r["rows"]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, r["file"])), pa.array(np.arange(n)), pa.array(np.frombuffer(r["ids"], "<i8")), pa.array([r["digests"][k : k + 32] for k in range(0, 32 * n, 32)], pa.binary())], names=["file", "row", "id", "digest"])

    return manifest.select("file", "rows", "ids", "digests").mapInArrow(run, "file long, row long, id long, digest binary")


def read_texts(uri: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, bytes, offsets) of a stored file."""
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSystem

    fs, path = FileSystem.from_uri(uri)
    table = pq.read_table(path, filesystem=fs, columns=["id", "text"], partitioning=None).combine_chunks()
    texts = table["text"].cast(pa.large_string()).combine_chunks()
    texts = texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks)
    return table["id"].to_numpy(), *text_bytes(texts)


#: Tasks of a pass over the files; beyond that a task works off several files in turn.
MOST_TASKS = 50_000


def over_files(files: DataFrame, n_files: int, work: Callable[[dict], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """work(row) -> batches, for each row (file, uri, ..) of files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from work(row)

    return files.repartition(max(1, min(n_files, MOST_TASKS))).mapInArrow(run, schema)


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its keys) of the buckets that have some."""
    bucket = keys % np.uint64(buckets)
    by = np.argsort(bucket, kind="stable")
    bounds = np.flatnonzero(np.concatenate([[True], bucket[by][1:] != bucket[by][:-1], [True]])) if len(by) else np.zeros(1, np.int64)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield int(bucket[by[a]]), by[a:b]


BLOBS = "file long, bucket long, data binary"


def replies_by_file(rows: DataFrame) -> DataFrame:
    """Each file's replies as one array."""
    return rows.groupBy("file").agg(F.collect_list(F.struct("bucket", "data")).alias("replies"))


def blobs(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    file, bucket, data = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(file, pa.int64()), pa.array(bucket, pa.int64()), pa.array(data, pa.binary())], names=["file", "bucket", "data"])


def rows_by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """(bucket, [(file, data)]) of rows that come sorted by bucket."""
    now, held = None, []
    for batch in batches:
        for file, bucket, data in zip(*(batch.column(c).to_pylist() for c in ("file", "bucket", "data"))):
            if bucket != now:
                if held:
                    yield now, held
                now, held = bucket, []
            held.append((file, data))
    if held:
        yield now, held


def meet(sent: DataFrame, buckets: int, how) -> DataFrame:
    """The replies of how to what was sent, bucket by bucket; a task works off several buckets in turn where there are more than tasks."""
    return sent.repartition(min(buckets, MOST_TASKS), "bucket").sortWithinPartitions("bucket", "file").mapInArrow(how, BLOBS)


def meet_keys(kind: str):
    """How files that sent distinct keys learn, by a bit for each, which of them other files have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in rows_by_bucket(batches):
            parts = [np.frombuffer(x, kind) for _, x in held]
            every = np.concatenate(parts)
            many = np.zeros(len(every), bool)
            # a part has all copies of its keys
            n = max(1, -(-len(every) // PART_KEYS))
            part_of = (mix(every.astype(np.uint64)) % np.uint64(n)).astype(np.int32) if n > 1 else None
            for k in range(n):
                mine = np.flatnonzero(part_of == k) if n > 1 else np.arange(len(every))
                _, inverse, counts = np.unique(every[mine], return_inverse=True, return_counts=True)
                many[mine] = (counts > 1)[inverse]
            at, out = 0, []
            for (file, _), part in zip(held, parts):
                out.append((file, bucket, np.packbits(many[at : at + len(part)]).tobytes()))
                at += len(part)
            yield blobs(out)

    return run
