"""Hand-computed cases at the boundaries of the rules."""

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from digestlake.functions import patterns as P
from digestlake.functions import scores as S
from digestlake.functions import text as T
from digestlake.functions import vectors as V


def one(spark, column, **values):
    ddl = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'boolean' if isinstance(v, bool) else 'bigint'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], ddl).select(column.alias("x")).first()["x"]


def text(spark, f, t):
    return one(spark, f("text"), text=t)


@pytest.mark.parametrize("likes,want", [(999, "low"), (1000, "medium"), (9999, "medium"), (10000, "high"), (49999, "high"), (50000, "viral"), (None, "low")])
def test_tier(spark, likes, want):
    df = spark.createDataFrame([(likes,)], "likes bigint")
    assert df.select(T.tier("likes")).first()[0] == want


def test_extraction(spark):
    assert text(spark, T.hashtags, "#Bitcoin #日本語 a#½b") == ["bitcoin", "日本語", "½b"]
    assert text(spark, T.mentions, "@Saylor hi @x_y") == ["saylor", "x_y"]
    assert text(spark, T.urls, "see https://a.b/c?d and http://e f") == ["https://a.b/c?d", "http://e"]
    assert text(spark, T.cashtags, "$ABCDEFG $BTC $b") == ["ABCDE", "BTC"]
    for f in (T.hashtags, T.mentions, T.urls, T.cashtags, T.news_entities, T.capital_entities, T.canonical_entities):
        assert text(spark, f, None) == [] and text(spark, f, "") == []


def test_topics(spark):
    assert text(spark, T.topics, "nothing here") == ["general"]
    assert text(spark, T.topics, None) == ["general"]
    assert text(spark, T.topics, "OpenAI and bitcoin on Mars") == ["ai", "crypto", "science"]
    assert text(spark, T.topics, "thanks @saylor") == ["crypto"]
    assert text(spark, T.topics, "é ai é") == ["ai"] and text(spark, T.topics, "éai") == ["general"]
    assert one(spark, T.force_topics(F.array(F.lit("general")), ["a", "b"]), text="") == ["b", "a"]
    assert one(spark, T.force_topics(F.array(F.lit("ai"), F.lit("crypto")), ["crypto"]), text="") == ["ai", "crypto"]


def test_entities(spark):
    assert text(spark, T.canonical_entities, "iPhone") == ["Phone"]
    assert set(text(spark, T.canonical_entities, "$btc #Foo ソラナ The Etf")) == {"Bitcoin", "#Foo", "Foo", "Solana", "ETF"}
    assert text(spark, T.canonical_entities, "$ABCDEFGH") == ["ABCDEFGH"]
    assert text(spark, T.capital_entities, "The Fox! #tag $ABC fox") == ["Fox", "ABC", "tag"]
    assert text(spark, T.news_entities, "The Foxes are #Up") == ["Foxes", "Up"]


def test_content_type(spark):
    for values, want in (((True, True, "x"), "retweet"), ((False, True, "x"), "quote"), ((False, False, "@a hi"), "reply"), ((None, None, None), "original")):
        df = spark.createDataFrame([values], "r boolean, q boolean, t string")
        assert df.select(T.content_type("t", "r", "q")).first()[0] == want


def test_times(spark):
    assert text(spark, T.parsed_time, "Mon Jan 20 18:45:23 +0000 2026") == datetime(2026, 1, 20, 18, 45, 23)
    assert text(spark, T.parsed_time, "garbage") is None and text(spark, T.parsed_time, "") is None


def test_clean(spark):
    assert text(spark, T.clean, "RT  hello via @x https://t.co/a  #tag @who") == "hello tag @USER"


def promo(spark, t, name="someone"):
    return one(spark, F.round(S.promo(), 6), text=t, screen_name=name)


def test_promo(spark):
    assert promo(spark, "Sign up now, use code X") == 0.7
    assert promo(spark, "#a #b #c #d #e") == 0.15 and promo(spark, "#a #b #c #d") == 0
    assert promo(spark, "😀 " * 7) == 0.1 and promo(spark, "😀" * 7) == 0
    assert promo(spark, "http://x") == 0.1
    assert promo(spark, "plain", "bestdeals") == 0.2
    assert promo(spark, None, None) == 0


@pytest.mark.parametrize("users,want", [(1, 0.0), (2, 0.075), (5, 0.3), (9, 0.3)])
def test_corroboration_term(spark, users, want):
    df = spark.createDataFrame([("@a", 50, 100, False, users)], "text string, likes bigint, followers bigint, verified boolean, c int")
    assert df.select(F.round(S.news(F.col("c")), 6)).first()[0] == want


@pytest.mark.parametrize("followers,want", [(100, 0.0), (101, 0.15)])
def test_ratio_term(spark, followers, want):
    df = spark.createDataFrame([("@a", 50, followers, False)], "text string, likes bigint, followers bigint, verified boolean")
    assert df.select(F.round(S.news(F.lit(0)), 6)).first()[0] == want


def test_reliability_floor_and_farming(spark):
    df = spark.createDataFrame([(False, False, 100, 1000, 0.0, 1.0), (True, True, 999_999, 0, 1.0, 0.0)], "verified boolean, curated boolean, followers bigint, likes bigint, news_score double, promo_score double")
    assert [round(r[0], 6) for r in df.select(S.reliability()).collect()] == [0.0, 1.2]


def test_counts_and_cuts(spark):
    assert [one(spark, T.short_count("n"), n=n) for n in (999, 2500, 1_250_000)] == ["999", "3k", "1.3M"]
    assert text(spark, lambda t: T.truncated(t, 60), "x" * 60) == "x" * 60
    assert text(spark, lambda t: T.truncated(t, 60), "x" * 61) == "x" * 10 + "\n\n... (truncated)"
    assert text(spark, T.sanitized, "a\x00b\n\n\n\n\nc") == "ab\n\nc"
    assert text(spark, T.slack_links, "[a](https://b) [c](http://d)") == "<https://b|a> [c](http://d)"
    assert text(spark, lambda t: T.one_line(t, 220, "..."), "y" * 220) == "y" * 220
    assert text(spark, lambda t: T.one_line(t, 220, "..."), "y" * 221) == "y" * 220 + "..."


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, z array<double>")
    r = df.select(V.unit(F.col("a")), V.unit(F.col("z")), V.dot(F.col("a"), F.col("a")), V.distance(F.col("a"), F.col("z"))).first()
    assert list(r) == [[0.6, 0.8], [0.0, 0.0], 25.0, 5.0]


def test_patterns_have_both_forms():
    import re

    for group in (*P.TOPICS.values(), P.CALLS_TO_ACTION, P.THREAD_BAIT, P.NEWS, P.FACTS):
        for p in group:
            assert r"\b" not in P.re2(p) or "%" in p
            re.compile(p)


def test_words_tell_what_expressions_tell(spark):
    rng = random.Random(3)
    lists = [P.CALLS_TO_ACTION, P.THREAD_BAIT, P.AFFILIATE_LINKS, P.NEWS, P.FACTS, [p for ps in P.TOPICS.values() for p in ps], [P.exactly(n) for n in P.COMPANIES + P.PRODUCTS]]
    words = sorted({w for ps in lists for p in ps for forms in [P.needs(p) or []] for ws, parts, _ in forms for w in ws + parts})
    joints = [" "] * 8 + [" @", "% ", "'", "-", ".", "_", "é", "=", "", "\n", "#", " 5", "🧵", "&", "\u0301"]
    texts = ["", None, "1/ x", "50% off", "x%y", "update K to", "ſaid", "mıllion", "İpo"]
    for _ in range(600):
        some = rng.sample(words, 6)
        texts.append("".join(rng.choice([w, w.upper(), w.title(), w + "s"]) + rng.choice(joints) for w in some))
    whole = [p for ps in lists for p in ps]
    texts += [re.sub(r"\\b|\(\?:|\)|\?|\|.*?(?=\)|$)", "", p) for p in whole]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    by_words = T.with_words("text", whole, lambda s: F.array(*[T.occurs(s, [p]) for p in whole]))
    by_search = F.array(*[F.coalesce("text", F.lit("")).rlike(P.any_java([p])) for p in whole])
    found = rows.select("text", by_words.alias("a"), by_search.alias("b")).collect()
    for r in found:
        assert r["a"] == r["b"], (r["text"], [p for p, x, y in zip(whole, r["a"], r["b"]) if x != y])
    assert sum(map(any, zip(*[r["b"] for r in found]))) > 0.8 * len(whole)
