"""Corroboration, promotional and news scores, and the filter that they feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestlake.functions import scores as S
from digestlake.functions import text as T

from digestlake.sources.tables import written

from . import ranking


def _named(posts: DataFrame) -> DataFrame:
    """(id, user, entities): the lower-cased entities of each post; an unknown account is one account."""
    return posts.select("id", F.coalesce("screen_name", F.lit("")).alias("user"), (F.col("_names") if "_names" in posts.columns else _names()).alias("entities"))


def _names():
    return F.array_distinct(F.transform(T.news_entities("text"), F.lower))


def _accounts(named: DataFrame) -> DataFrame:
    return named.select("user", F.explode("entities").alias("entity")).distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("users"))


def corroboration(posts: DataFrame) -> DataFrame:
    """(entity, users): how many accounts name each lower-cased entity; an unknown account counts as one."""
    return _accounts(_named(posts))


def corroborated(posts: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """posts with the largest corroboration of their entities, keyed by id; 0 without entities. Entities are found once and written, without the texts."""
    named = _named(posts) if "_names" in posts.columns else written(_named(posts), "entities")
    best = named.select("id", F.explode("entities").alias("entity")).join(_accounts(named) if counts is None else counts, "entity").groupBy("id").agg(F.max("users").alias("corroboration"))
    return posts.join(best, "id", "left").withColumn("corroboration", F.coalesce("corroboration", F.lit(0)))


def scored(posts: DataFrame) -> DataFrame:
    """posts with promo_raw, news_raw and their values rounded to three digits.

    What a text gives is found once and written with its post: thresholds, which Spark moves below joins, and scores, which it repeats above them, would search the text again, and posts would be deduplicated twice.
    """
    rows = written(posts.withColumns({"_names": _names(), "_found": S.found()}), "scored")
    out = corroborated(rows).withColumn("promo_raw", S.promo(seen=F.col("_found"))).withColumn("news_raw", S.news(F.col("corroboration"), seen=F.col("_found"))).drop("_names", "_found")
    return out.withColumn("promo_score", F.round("promo_raw", 3)).withColumn("news_score", F.round("news_raw", 3))


def kept(posts: DataFrame, most_promo: float = 0.4, least_news: float = 0.0) -> DataFrame:
    """Posts under the promotional threshold and not under the news threshold, by unrounded scores."""
    return posts.where((F.col("promo_raw") < most_promo) & (F.col("news_raw") >= least_news))


def ranked(posts: DataFrame) -> DataFrame:
    """posts with composite and rank, best first, ties in order of arrival."""
    return ranking.ranked(posts.withColumn("composite", F.round(F.col("news_score") - 0.5 * F.col("promo_score"), 6)), [F.desc("composite"), F.asc("_ord")])


def counters(posts: DataFrame, most_promo: float = 0.4, least_news: float = 0.0) -> DataFrame:
    promo = F.col("promo_raw") >= most_promo
    return posts.agg(F.count(F.lit(1)).alias("n"), F.count_if(promo).alias("promo_removed"), F.count_if(~promo & (F.col("news_raw") < least_news)).alias("news_removed"))


def score_stats(posts: DataFrame) -> DataFrame:
    out = [f(c).alias(f"{c}_{name}") for c in ("promo_score", "news_score") for name, f in (("min", F.min), ("max", F.max), ("mean", lambda x: F.round(F.avg(x), 6)))]
    return posts.agg(*out)
