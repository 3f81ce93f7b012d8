"""Sharding by proportional stratified interleaving (law `rows`).

Rows are shuffled by a seeded key and ranked within their source; a row of rank r among the n
rows of its source stands at the fraction (r + 1/2) / n. Sorting all rows by that fraction
interleaves the sources in proportion, so every contiguous cut has the mixture of the whole.

No rank is taken by one task. The key is uniform, so its leading bits split each source into
slices of bounded size: a slice's first rank is the running sum of the slices before it, and
row_number() only runs inside a slice. A source with a third of the rows is simply cut
into more slices. The global order is a range sort by all columns that decide it, so rows of one fraction, which very many
small sources may share, are dealt over several partitions; sorted rows are stored with their place in their partition, and a
partition's first position is the running sum over the partitions before it.

Defined results: a null source is a stratum of its own; a null text has no bytes; a null doc_id
is shuffled by the empty key; rows equal in all these columns may swap places with each other.
An empty table gives no rows. Texts of any length are only measured and summed where they are read. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored, text_or_empty

KEY_BITS = 60
SLICE_ROWS = 1 << 10
#: Rows of a partition of the range sort, which are a few bytes each.
PART_ROWS = 1 << 22


def _running_start(counts: DataFrame, by: list[str], order: str) -> DataFrame:
    """counts(by.., order, n) with the sum of n in the preceding rows as first."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("n").over(w), F.lit(0)))


def interleave(docs: DataFrame, n_shards: int, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "source") -> DataFrame:
    """(doc_id, size, text_crc32, stratum, position, shard, slot) of every row of docs.

    Shard sizes differ by one row at most; slot counts from 0 in each shard.
    """
    total = docs.count()
    bits = max(4, min(40, (max(1, total // SLICE_ROWS)).bit_length()))
    text = text_or_empty(text_col)
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, KEY_BITS // 4), 16, 10).cast("long")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col(stratum_col).cast("string")), F.lit("-")).alias("stratum"),
        key.alias("key"),
    ).withColumn("slice", F.shiftright("key", KEY_BITS - bits))

    counts = rows.groupBy("stratum", "slice").agg(F.count(F.lit(1)).alias("n"))
    starts = _running_start(counts, ["stratum"], "slice").join(counts.groupBy("stratum").agg(F.sum("n").alias("of")), "stratum").select("stratum", "slice", "first", "of")
    inside = Window.partitionBy("stratum", "slice").orderBy("key", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("nth", F.row_number().over(inside)).join(starts, ["stratum", "slice"])
    ranked = ranked.withColumn("fraction", (F.col("first") + F.col("nth") - 0.5) / F.col("of"))

    order = ["fraction", "stratum", "key", "doc_id", "text_crc32", "size"]
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // PART_ROWS)
    ordered = ranked.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # the place in the partition is the low part of Spark's row number; it is stored, as ranges would differ if they were drawn again
    numbered = stored(ordered.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "interleaved")
    firsts = _running_start(numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n")), [], "part").select("part", "first")
    # a row for each partition of the sort: as many as parts
    placed = numbered.join(F.broadcast(firsts), "part").withColumn("position", F.col("first") + F.col("nth"))

    shard = F.expr(f"position * {n_shards} div {max(total, 1)}")
    return placed.select(
        "doc_id", "size", "text_crc32", "stratum", "position",
        shard.cast("int").alias("shard"),
        (F.col("position") - F.expr(shard_start(n_shards, total))).cast("long").alias("slot"),
    )


def shard_start(n_shards: int, total: int) -> str:
    """SQL for the first position of the shard that holds position: the least p with p * n_shards >= shard * total."""
    return f"((position * {n_shards} div {max(total, 1)}) * {total} + {n_shards - 1}) div {n_shards}"
