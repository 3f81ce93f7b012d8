"""Posts: the nested record, its flat form, and the posts view over the documents table.

The flat columns are id, text, created_at, ts, screen_name, verified, followers, likes, is_retweet, is_quote, _query and _ord; _ord
is the order of arrival, which settles ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestlake.functions.text import parsed_time

from . import jsonsplits

POST = (
    "struct<id:string,text:string,created_at:string,user:struct<name:string,screen_name:string,verified:boolean,followers:bigint>,"
    "metrics:struct<likes:bigint,retweets:bigint,replies:bigint,views:string>,is_retweet:boolean,is_quote:boolean,_query:string>"
)


def read_json(spark: SparkSession, path: str, split_bytes: int = jsonsplits.SPLIT_BYTES) -> DataFrame:
    """Nested posts of JSON files that each hold a list of posts or an envelope {tweets, stats}, in the order of their bytes.

    The schema is given, not inferred. A file is read in ranges of split_bytes by several tasks, though an array spans lines.
    """
    listed = jsonsplits.records(spark, path, split_bytes)
    return listed.select(F.struct("file", "at").alias("_ord"), F.from_json("value", POST).alias("post")).select("_ord", "post.*")


def flat(posts: DataFrame) -> DataFrame:
    """The nested record with missing values replaced: likes and followers 0, text empty."""
    order = F.col("_ord") if "_ord" in posts.columns else F.lit(0)
    return posts.select(
        "id", F.coalesce("text", F.lit("")).alias("text"), "created_at", parsed_time("created_at").alias("ts"),
        F.coalesce("user.screen_name", F.lit("")).alias("screen_name"), F.coalesce("user.verified", F.lit(False)).alias("verified"), F.coalesce("user.followers", F.lit(0)).alias("followers"),
        F.coalesce("metrics.likes", F.lit(0)).alias("likes"), F.coalesce("is_retweet", F.lit(False)).alias("is_retweet"), F.coalesce("is_quote", F.lit(False)).alias("is_quote"),
        "_query", order.alias("_ord"),
    )


def latest(paths: list[str]) -> str | None:
    """The last file by name, of a listing."""
    return max(paths, default=None, key=lambda p: p.rsplit("/", 1)[-1])


#: The decoration is invented: documents have no tags, links, tickers or calls to action of their own.
VIEW = """
SELECT CAST(d.doc_id AS {S}) AS id,
  concat(CASE WHEN d.doc_id % 11 = 0 THEN '@saylor ' WHEN d.doc_id % 13 = 0 THEN 'BREAKING: ' ELSE '' END, d.text,
    CASE d.doc_id % 9 WHEN 0 THEN ' #Bitcoin' WHEN 1 THEN ' $ETH ETF approved' WHEN 2 THEN ' OpenAI announced GPT-5' WHEN 3 THEN ' Sign up https://t.example/?utm_source=x'
      WHEN 4 THEN ' ビットコイン #仮想通貨' WHEN 5 THEN ' according to the SEC report, 3 million' WHEN 6 THEN ' #a #b #c #d #e giveaway' ELSE '' END) AS text,
  {CS} AS created_at, {TS} AS ts, d.source AS screen_name, coalesce(l.quality = 1, false) AS verified, (d.doc_id * 7919) % 200000 AS followers,
  CASE WHEN d.doc_id % 97 = 0 THEN 50000 + d.n_chars ELSE d.n_chars END AS likes, d.doc_id % 10 = 7 AS is_retweet, d.doc_id % 10 = 8 AS is_quote,
  concat('q', CAST(d.doc_id % 3 AS {S})) AS _query, d.doc_id AS _ord
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""
_SPARK = {"S": "STRING", "TS": "timestampadd(MINUTE, d.doc_id * 37 % 4320, TIMESTAMP_NTZ'2024-01-01 00:00:00')"}
_SPARK["CS"] = f"date_format({_SPARK['TS']}, 'EEE MMM dd HH:mm:ss') || ' +0000 ' || date_format({_SPARK['TS']}, 'yyyy')"
_DUCK = {"S": "VARCHAR", "TS": "TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(d.doc_id * 37 % 4320 AS INTEGER))"}
_DUCK["CS"] = f"strftime({_DUCK['TS']}, '%a %b %d %H:%M:%S +0000 %Y')"


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat posts derived from documents and labels."""
    return spark.sql(
        VIEW.format(**_SPARK).replace("FROM documents", "FROM {documents}").replace("JOIN labels", "JOIN {labels}"),
        documents=spark.read.parquet(f"{sf_dir}/documents.parquet"),
        labels=spark.read.parquet(f"{sf_dir}/labels.parquet"),
    )


def view_sql() -> str:
    """The same view for DuckDB."""
    return VIEW.format(**_DUCK)


def with_copies(posts: DataFrame) -> DataFrame:
    """Every seventh post once more, from another query."""
    again = posts.where("_ord % 7 = 0").withColumn("_query", F.lit("again")).withColumn("_ord", F.col("_ord") + 1_000_000_000)
    return posts.unionByName(again)
