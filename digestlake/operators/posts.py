"""Deduplication, filters, enrichment and corpus statistics of posts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestlake.functions import text as T


def dedup_first(posts: DataFrame, key: str = "id", order: str = "_ord") -> DataFrame:
    """The first post of each id; posts without an id go. Aggregated before the shuffle, unlike a window."""
    some = posts.where(F.col(key).isNotNull() & (F.col(key) != ""))
    return some.groupBy(key).agg(F.min_by(F.struct(*posts.columns), order).alias("p")).select("p.*")


def dedup_provenance(posts: DataFrame, key: str = "id", order: str = "_ord", query: str = "_query") -> DataFrame:
    """As dedup_first, with the queries of all copies joined by | in order."""
    some = posts.where(F.col(key).isNotNull() & (F.col(key) != ""))
    seen = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, query))), lambda s: s[query]), "|")
    rest = [c for c in posts.columns if c != query]
    return some.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("p"), seen.alias(query)).select("p.*", query)


def within_age(posts: DataFrame, as_of: datetime, hours: float, ts: str = "ts") -> DataFrame:
    """Posts no older than so many hours, or of unknown time; no limit if hours is not positive."""
    if hours <= 0:
        return posts
    return posts.where(F.col(ts).isNull() | (F.col(ts) >= F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(hours * 3600.0))))


def originals(posts: DataFrame) -> DataFrame:
    return posts.where(~F.coalesce("is_retweet", F.lit(False)))


def enough(posts: DataFrame, least: int = 20) -> DataFrame:
    """All posts, or none where they are fewer than a clustering takes. The count is one row joined on."""
    one = posts.agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select(F.lit(True).alias("_enough"))
    return posts.crossJoin(F.broadcast(one)).drop("_enough")


def search(posts: DataFrame, least_likes: int = 0, links: bool = False, account: str | None = None, replies: bool = True) -> DataFrame:
    """What remote search operators select: min_faves, filter:links, from and -filter:replies."""
    out = posts.where(F.col("likes") >= least_likes)
    if links:
        out = out.where(F.size(T.urls("text")) > 0)
    if account is not None:
        out = out.where(F.lower("screen_name") == account.lower())
    return out if replies else out.where(T.content_type("text", "is_retweet", "is_quote") != "reply")


def enrich(posts: DataFrame, forced: list[str] | None = None) -> DataFrame:
    """posts with extracted: tags, mentions, links, topics, entities, tier and content type."""
    topics = T.force_topics(F.col("_topics"), forced or [])
    nobody = F.expr("cast(array() as array<string>)")
    entities = F.struct(nobody.alias("people"), T.named("text", T.P.COMPANIES).alias("companies"), T.named("text", T.P.PRODUCTS).alias("products"))
    extracted = F.struct(
        T.hashtags("text").alias("hashtags"), T.mentions("text").alias("mentions"), T.urls("text").alias("urls"), topics.alias("topics"), entities.alias("entities"),
        T.tier("likes").alias("engagement_tier"), T.content_type("text", "is_retweet", "is_quote").alias("content_type"),
    )
    return posts.withColumn("_topics", T.topics("text")).withColumn("extracted", extracted).drop("_topics")


def distribution(posts: DataFrame, value: Column, name: str, several: bool = False) -> DataFrame:
    """(name, n) of a value, or of each of several."""
    return posts.select((F.explode(value) if several else value).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def share(counts: DataFrame, total: DataFrame, digits: int = 4) -> DataFrame:
    """counts with pct of the number of rows of total, which is one row joined on."""
    one = total.agg(F.count(F.lit(1)).alias("total"))
    return counts.crossJoin(F.broadcast(one)).select(*counts.columns, F.round(100.0 * F.col("n") / F.col("total"), digits).alias("pct"))


def corpus_stats(posts: DataFrame) -> DataFrame:
    return posts.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("screen_name").alias("accounts"), F.sum("likes").cast("bigint").alias("likes"),
        F.round(100.0 * F.count_if("is_retweet") / F.count(F.lit(1)), 4).alias("retweet_pct"),
    )
