"""Score columns. Terms are added in a fixed order, in doubles, so that other engines can repeat the sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from . import text as T


def _if(condition: Column, value: float) -> Column:
    return F.when(condition, F.lit(value)).otherwise(F.lit(0.0))


def _promo_parts(s: Column) -> list[Column]:
    """What promo needs of a text, given as a struct of with_words. The dear searches run only where a cheap test leaves a chance."""
    t = s["text"]
    bare = F.regexp_replace(F.regexp_replace(t, r"https?://[^\s\p{Z}]+", ""), rf"^{P.BLANK}+|{P.BLANK}+$", "")
    return [
        T.hits(s, P.CALLS_TO_ACTION).alias("calls"), T.occurs(s, P.THREAD_BAIT).alias("bait"), T.occurs(s, P.AFFILIATE_LINKS).alias("affiliate"),
        (F.contains(t, F.lit("#")) & (F.size(T.raw_hashtags(t)) > 4)).alias("tags"),
        ((F.octet_length(t) > F.length(t)) & (F.regexp_count(t, F.lit(P.EMOJI)) > 6)).alias("emoji"),
        (F.contains(t, F.lit("http")) & (F.length(bare) < 30)).alias("bare"),
    ]


def _news_parts(s: Column) -> list[Column]:
    return [T.hits(s, P.NEWS).alias("news"), T.hits(s, P.FACTS).alias("facts"), s["text"].startswith("@").alias("reply")]


def found(text="text") -> Column:
    """All that promo and news need of a text, in one struct, for which the text is split into words once."""
    return T.with_words(text, P.CALLS_TO_ACTION + P.THREAD_BAIT + P.AFFILIATE_LINKS + P.NEWS + P.FACTS, lambda s: F.struct(*_promo_parts(s), *_news_parts(s)))


def _of(seen: Column | None, text, patterns: list[str], parts, total) -> Column:
    """total of what was found before, or is found in the text now."""
    return total(seen) if seen is not None else F.transform(F.array(T.with_words(text, patterns, lambda s: F.struct(*parts(s)))), total)[0]


def promo(text="text", screen_name="screen_name", seen: Column | None = None) -> Column:
    total = lambda found: F.least(
        F.lit(1.0),
        F.least(found["calls"] * F.lit(0.35), F.lit(0.7))
        + _if(found["bait"], 0.1)
        + _if(found["affiliate"], 0.3)
        + _if(F.lower(F.coalesce(F.col(screen_name), F.lit(""))).rlike(P.any_java(P.PROMO_ACCOUNTS)), 0.2)
        + _if(found["tags"], 0.15)
        + _if(found["emoji"], 0.1)
        + _if(found["bare"], 0.1),
    )
    return _of(seen, text, P.CALLS_TO_ACTION + P.THREAD_BAIT + P.AFFILIATE_LINKS, _promo_parts, total)


def ratio_term(likes, followers, first: float, high: float, second: float, low: float) -> Column:
    n, f = F.coalesce(F.col(likes), F.lit(0)), F.coalesce(F.col(followers), F.lit(0))
    ratio = n / F.when(f > 100, f)
    return F.when(ratio > first, F.lit(high)).when(ratio > second, F.lit(low)).otherwise(F.lit(0.0))


def news(corroboration: Column, text="text", likes="likes", followers="followers", verified="verified", seen: Column | None = None) -> Column:
    c = F.coalesce(corroboration, F.lit(0))
    total = lambda found: F.least(
        F.lit(1.0),
        F.least(found["news"] * F.lit(0.1), F.lit(0.2))
        + F.least(found["facts"] * F.lit(0.05), F.lit(0.15))
        + F.when(c > 1, F.least((c - 1) * F.lit(0.075), F.lit(0.3))).otherwise(F.lit(0.0))
        + ratio_term(likes, followers, 0.1, 0.15, 0.01, 0.08)
        + _if(~found["reply"], 0.1)
        + _if(F.coalesce(F.col(verified), F.lit(False)) | (F.coalesce(F.col(followers), F.lit(0)) >= 50000), 0.1),
    )
    return _of(seen, text, P.NEWS + P.FACTS, _news_parts, total)


def quality_account(verified="verified", curated="curated", followers="followers", floor: int = 5000) -> Column:
    return F.coalesce(F.col(verified), F.lit(False)) | F.col(curated) | (F.coalesce(F.col(followers), F.lit(0)) >= floor)


def reliability(verified="verified", curated="curated", followers="followers", likes="likes", news_score="news_score", promo_score="promo_score") -> Column:
    v, c = F.coalesce(F.col(verified), F.lit(False)), F.col(curated)
    f, n = F.coalesce(F.col(followers), F.lit(0)), F.coalesce(F.col(likes), F.lit(0))
    farming = ~v & ~c & (f > 0) & (f < 2000) & (n / F.greatest(f, F.lit(1)) > 1.5)
    total = (
        _if(c, 0.35)
        + _if(v, 0.40)
        + F.when(f > 0, F.lit(0.25) * F.least(F.lit(1.0), F.log10((f + 1).cast("double")) / 6.0)).otherwise(F.lit(0.0))
        + ratio_term(likes, followers, 0.05, 0.15, 0.01, 0.075)
        + F.lit(0.20) * F.coalesce(F.col(news_score), F.lit(0.0))
        - F.lit(0.10) * F.coalesce(F.col(promo_score), F.lit(0.0))
        - _if(farming, 0.30)
    )
    return F.greatest(F.lit(0.0), total)


def momentum(quality="quality", verified="n_verified", recent="recent", entity="entity") -> Column:
    base = F.col(quality) + F.lit(0.5) * F.col(verified) + F.lit(0.5) * F.col(recent)
    return base * F.when(F.col(entity).isin(P.BROAD), F.lit(0.6)).otherwise(F.lit(1.0))
