"""Captured result pages: nested instructions and entries to posts and cursors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

USER = "core:struct<name:string,screen_name:string>,legacy:struct<name:string,screen_name:string,followers_count:bigint,verified:boolean>,is_blue_verified:boolean"
#: The columns of a result, which a wrapped result holds in tweet.
COLUMNS = {
    "rest_id": "string",
    "legacy": "struct<id_str:string,full_text:string,created_at:string,favorite_count:bigint,retweet_count:bigint,reply_count:bigint,retweeted_status_result:struct<rest_id:string>,is_quote_status:boolean>",
    "views": "struct<count:string>",
    "core": f"struct<user_results:struct<result:struct<{USER}>>>",
}
TWEET = ",".join(f"{k}:{v}" for k, v in COLUMNS.items())
CONTENT = f"struct<value:string,itemContent:struct<tweet_results:struct<result:struct<__typename:string,tweet:struct<{TWEET}>,{TWEET}>>>>"
INSTRUCTIONS = f"array<struct<type:string,entries:array<struct<entryId:string,content:{CONTENT}>>,moduleItems:array<struct<entryId:string,item:{CONTENT}>>>>"
LIST = f"struct<instructions:{INSTRUCTIONS}>"
PAGE = f"data struct<home:struct<home_timeline_urt:{LIST}>,search_by_raw_query:struct<search_timeline:struct<timeline:{LIST}>>>"


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row (page, instructions) for each captured page, of a timeline or of a search."""
    raw = spark.read.schema(PAGE).option("multiLine", True).json(path)
    return raw.select(F.input_file_name().alias("page"), F.coalesce("data.home.home_timeline_urt.instructions", "data.search_by_raw_query.search_timeline.timeline.instructions").alias("instructions"))


def parse(texts: DataFrame, page: str = "page", text: str = "text") -> DataFrame:
    """As read, of JSON texts that are in a column."""
    raw = texts.select(F.col(page).alias("page"), F.from_json(text, PAGE).alias("p"))
    return raw.select("page", F.coalesce("p.data.home.home_timeline_urt.instructions", "p.data.search_by_raw_query.search_timeline.timeline.instructions").alias("instructions"))


def entries(pages: DataFrame, modules: bool = True) -> DataFrame:
    """(page, at, entryId, content) of added entries and, of searches, added module items."""
    each = pages.select("page", F.posexplode("instructions").alias("i", "x"))
    added = each.where("x.type = 'TimelineAddEntries'").select("page", "i", F.posexplode("x.entries").alias("j", "e")).select("page", F.struct("i", "j").alias("at"), "e.entryId", "e.content")
    if not modules:
        return added
    items = each.where("x.type = 'TimelineAddToModule'").select("page", "i", F.posexplode("x.moduleItems").alias("j", "e"))
    return added.unionByName(items.select("page", F.struct("i", "j").alias("at"), "e.entryId", F.col("e.item").alias("content")))


def user(result: Column) -> Column:
    """The newer place of an account's name, then the older one, then Unknown."""
    said = lambda name: F.coalesce(F.nullif(result["core"][name], F.lit("")), F.nullif(result["legacy"][name], F.lit("")))
    known = said("screen_name").isNotNull()
    return F.struct(
        F.when(known, F.coalesce(said("name"), F.lit("Unknown"))).otherwise("Unknown").alias("name"),
        F.coalesce(said("screen_name"), F.lit("unknown")).alias("screen_name"),
        F.when(known, F.coalesce(result["is_blue_verified"], F.lit(False)) | F.coalesce(result["legacy"]["verified"], F.lit(False))).otherwise(F.lit(False)).alias("verified"),
        F.when(known, F.coalesce(result["legacy"]["followers_count"], F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("followers"),
    )


def posts(entry_rows: DataFrame, query: str | None = None) -> DataFrame:
    """Nested posts of entries whose id begins with tweet-; wrapped results are unwrapped, results without content go."""
    result = F.col("content.itemContent.tweet_results.result")
    some = entry_rows.where(F.col("entryId").startswith("tweet-")).withColumn("r", F.when(result["__typename"] == "TweetWithVisibilityResults", result["tweet"]).otherwise(F.struct(*[result[c].alias(c) for c in COLUMNS])))
    some = some.where("r.legacy is not null")
    number = lambda name: F.coalesce(F.col(f"r.legacy.{name}"), F.lit(0)).cast("bigint")
    return some.select(
        F.coalesce("r.legacy.id_str", "r.rest_id").alias("id"), F.coalesce("r.legacy.full_text", F.lit("")).alias("text"), F.coalesce("r.legacy.created_at", F.lit("")).alias("created_at"),
        user(F.col("r.core.user_results.result")).alias("user"),
        F.struct(number("favorite_count").alias("likes"), number("retweet_count").alias("retweets"), number("reply_count").alias("replies"), F.coalesce("r.views.count", F.lit("0")).alias("views")).alias("metrics"),
        F.col("r.legacy.retweeted_status_result").isNotNull().alias("is_retweet"), F.coalesce("r.legacy.is_quote_status", F.lit(False)).alias("is_quote"),
        F.lit(query).cast("string").alias("_query"), F.struct("page", "at").alias("_ord"),
    )


def cursors(entry_rows: DataFrame) -> DataFrame:
    """(page, cursor): the last bottom cursor of each page."""
    return entry_rows.where(F.col("entryId").contains("cursor-bottom")).groupBy("page").agg(F.max_by("content.value", "at").alias("cursor"))
