"""Entity momentum, story assignment and the parts of the digest."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestlake.functions import patterns as P
from digestlake.functions import scores as S
from digestlake.functions import text as T

from . import ranking


def with_accounts(posts: DataFrame, handles: list[str] | DataFrame) -> DataFrame:
    """posts with curated, trusted and quality; handles is a list, or a table with handle where it is large."""
    name = F.lower(F.coalesce("screen_name", F.lit("")))
    if isinstance(handles, DataFrame):
        known = handles.select(F.lower("handle").alias("_handle"), F.lit(True).alias("_known")).distinct()
        out = posts.join(known, name == F.col("_handle"), "left").withColumn("curated", F.coalesce("_known", F.lit(False))).drop("_handle", "_known")
    else:
        out = posts.withColumn("curated", name.isin([h.lower() for h in handles]))
    return out.withColumn("trusted", F.col("curated") | F.coalesce("verified", F.lit(False))).withColumn("quality_account", S.quality_account())


def _entities(posts: DataFrame) -> Column:
    """The entities of a post, which may have been found before."""
    return F.col("entities") if "entities" in posts.columns else T.canonical_entities("text")


def aggregate(posts: DataFrame, as_of: datetime, hours: float = 12) -> DataFrame:
    """(entity, tweets, quality, n_verified, n_curated, likes, recent, momentum) of every entity; a post counts once for an entity."""
    recent = F.col("ts").isNotNull() & (F.col("ts") >= F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(hours * 3600.0)))
    named = posts.withColumn("recent_post", recent).select("*", F.explode(_entities(posts)).alias("entity"))
    who = lambda condition: F.count_distinct(F.when(condition, F.coalesce("screen_name", F.lit(""))))
    out = named.groupBy("entity").agg(
        F.count(F.lit(1)).alias("tweets"), who(F.col("quality_account")).alias("quality"), who(F.coalesce("verified", F.lit(False))).alias("n_verified"), who(F.col("curated")).alias("n_curated"),
        F.sum(F.coalesce("likes", F.lit(0))).cast("bigint").alias("likes"), F.count_if("recent_post").alias("recent"),
    )
    return out.withColumn("momentum", S.momentum())


def stories(momentum: DataFrame, least_accounts: int = 2, most: int = 12) -> DataFrame:
    """The strongest entities with their number."""
    return ranking.numbered(momentum.where(F.col("quality") >= least_accounts), [F.desc("momentum"), F.asc("entity")], most, "story")


def assign(posts: DataFrame, top: DataFrame) -> DataFrame:
    """posts with the story that they belong to: specific entities before broad ones, then the strongest; null if none.

    top is the limited result of stories(), so it is broadcast.
    """
    small = top.select(F.col("entity").alias("story_entity"), "story", F.col("momentum").alias("story_momentum"))
    named = posts.select("id", F.explode(_entities(posts)).alias("story_entity")).join(F.broadcast(small), "story_entity")
    key = F.struct((~F.col("story_entity").isin(P.BROAD)).cast("int").alias("specific"), F.col("story_momentum"), (-F.col("story")).alias("first"))
    best = named.groupBy("id").agg(F.max_by(F.struct("story_entity", "story"), key).alias("b")).select("id", "b.*")
    return posts.join(best, "id", "left")


def _order() -> list:
    return [F.desc(F.col("trusted").cast("int")), F.desc("reliability"), F.asc("_ord")]


def story_sources(assigned: DataFrame, most: int = 6) -> DataFrame:
    return ranking.top_per_group(assigned.where("story is not null"), ["story", "story_entity"], _order(), most)


def other_notable(assigned: DataFrame, most: int = 8) -> DataFrame:
    return ranking.numbered(assigned.where("story is null"), _order(), most)
