"""What the operators of this subpackage have in common: shared storage and sizing."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


#: What Python workers keep between tasks; workers go from stage to stage, so a stage in need of memory releases it.
KEPT: list[dict] = []


def release() -> None:
    for kept in KEPT:
        kept.clear()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name that the driver and all executors reach, under spark.checkpoint.dir.

    Where that setting is absent (tests on one machine), a temporary folder of this machine
    takes its place, is recorded in the session and goes with the process. Elsewhere the folder `digestlake` under
    spark.checkpoint.dir can be cleared once results are written.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="digestlake-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        base = "file://" + own
        spark.conf.set("spark.checkpoint.dir", base)
    if "://" not in base and base.startswith("/"):
        base = "file://" + base
    return f"{base.rstrip('/')}/digestlake/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_texts(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches of fewer rows unless that was set: rows here are whole documents."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")
    return spark


#: Keys that count as hot at most, so that a table of them is small whatever the number of rows.
HOT_KEYS = 50_000
LEAST_HOT = 256


def join_hot(rows: DataFrame, facts: DataFrame, key: str, by: list, total: int, how: str = "left") -> DataFrame:
    """rows joined with facts(key, n, ..), which has one row for each key, n being the number of rows that have it.

    A key of more than a HOT_KEYS-th of the total rows is hot: at most HOT_KEYS are, so their names are broadcast. Rows of a hot key are dealt over
    several partitions by a hash of the columns by, and its fact is repeated for each. The result has no n. The join is by sort and merge.
    """
    most = max(LEAST_HOT, total // HOT_KEYS)
    splits = F.ceil(F.col("n") / most)
    hot = facts.where(F.col("n") > most).select(F.col(key).alias("hot_key"), splits.alias("hot_splits"))
    dealt = rows.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left").withColumn("salt", F.when(F.col("hot_splits").isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64(*by), F.col("hot_splits")))).drop("hot_key", "hot_splits")
    last = F.when(F.col("n") > most, splits - 1).otherwise(F.lit(0).cast("long"))
    spread = facts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("n")
    return dealt.hint("merge").join(spread, [key, "salt"], how).drop("salt")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole_texts(spark).read.parquet(f"{sf_dir}/documents.parquet")


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a Spark schema in text."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
