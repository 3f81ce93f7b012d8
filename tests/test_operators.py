import json
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from digestlake.operators import clustering, posts, ranking, render
from digestlake.plans.pipeline import Pipeline, Settings, digest, filtered
from digestlake.sources import config, pages, sinks
from digestlake.sources import posts as source
from digestlake.streaming import events

FLAT = "id string, text string, created_at string, ts timestamp_ntz, screen_name string, verified boolean, followers bigint, likes bigint, is_retweet boolean, is_quote boolean, _query string, _ord bigint"


def post(i, text="x", **k):
    base = {"id": str(i), "text": text, "created_at": "", "ts": datetime(2024, 1, 1), "screen_name": "a", "verified": False, "followers": 10, "likes": 1, "is_retweet": False, "is_quote": False, "_query": "q", "_ord": i}
    return tuple((base | k).values())


def test_dedup(spark):
    df = spark.createDataFrame([post(3, _query="b"), post(1, id="3", _query="a"), post(2, id=None), post(4, id="")], FLAT)
    assert [(r["id"], r["_ord"]) for r in posts.dedup_first(df).collect()] == [("3", 1)]
    assert posts.dedup_provenance(df).first()["_query"] == "a|b"
    again = posts.dedup_first(df)
    assert posts.dedup_first(again).collect() == again.collect()


def test_age(spark):
    df = spark.createDataFrame([post(1, ts=None), post(2, ts=datetime(2024, 1, 2)), post(3, ts=datetime(2024, 1, 1, 23, 59, 59))], FLAT)
    assert sorted(r["id"] for r in posts.within_age(df, datetime(2024, 1, 4), 48).collect()) == ["1", "2"]
    assert posts.within_age(df, datetime(2024, 1, 4), 0).count() == 3


def test_empty_digest(spark):
    s = Settings(as_of=datetime(2024, 1, 4))
    text = render.document(digest(filtered(spark.createDataFrame([], FLAT), s), s))
    assert text.endswith("*No tweets to report.*")


def test_digest_without_topics(spark):
    s = Settings(as_of=datetime(2024, 1, 4))
    text = render.document(digest(filtered(spark.createDataFrame([post(1, "plain words")], FLAT), s), s))
    assert "*No topic reached the momentum threshold.*" in text and "Other notable" in text


def test_tiers_rank_as_likes_do(spark, sf):
    p = source.view(spark, sf)
    a = ranking.top_per_group(p, ["screen_name"], [F.desc("likes"), F.asc("_ord")], 5).select("id", "rn")
    from digestlake.functions import text as T

    b = ranking.top_per_group(p, ["screen_name"], [T.tier_rank("likes").asc(), F.desc("likes"), F.asc("_ord")], 5).select("id", "rn")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_top_k_is_pruned_before_the_shuffle(spark, sf):
    plan = ranking.top_per_group(source.view(spark, sf), ["screen_name"], [F.desc("likes")], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_scan_is_pruned(spark, sf):
    plan = posts.originals(source.view(spark, sf)).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "text:string" not in plan.split("ReadSchema: ")[1].split("\n")[0]


def test_weighted_text(spark):
    text = "Hello Tesla $ETH #Bitcoin x"
    got = spark.createDataFrame([(text,)], "text string").select(clustering.weighted_text("text")).first()[0]
    assert got == "Hello Tesla $ETH Bitcoin x Bitcoin ETH Hello Tesla Bitcoin ETH Hello Tesla bitcoin bitcoin", got


def test_density():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 0.1, (40, 2)), rng.normal(5, 0.1, (40, 2)), rng.uniform(-20, 20, (5, 2))])
    for leaf in (False, True):
        label, prob = clustering.density_labels(x, 10, 5, leaf)
        assert set(label[:40]) - {-1} and set(label[40:80]) - {-1} and not (set(label[:40]) & set(label[40:80])) - {-1}
        assert (prob >= 0).all() and (prob <= 1).all()
    assert (clustering.density_labels(x[:3], 10, 5)[0] == -1).all()


@pytest.mark.parametrize("block", [23, 1000])
def test_density_in_blocks(spark, block):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 0.3, (60, 3)), rng.normal(4, 0.3, (50, 3)), rng.uniform(-9, 9, (15, 3))])
    made = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, clustering.density(made, block=block).collect()))
    label, prob = clustering.density_labels(x, 10, 5)
    groups = lambda labels: {frozenset(np.flatnonzero(labels == c)) for c in set(labels) - {-1}}
    assert groups(np.array([g[1] for g in got])) == groups(label) and len(groups(label)) == 2
    assert np.allclose([g[2] for g in got], prob)


def test_density_has_no_bound_of_its_own(spark):
    made = spark.range(20_001).selectExpr("id AS vec_id", "array(CAST(id AS DOUBLE)) AS embedding")
    assert clustering.density(made).columns == ["vec_id", "cluster", "probability"]


def test_density_refuses_large_sets(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    with pytest.raises(ValueError):
        clustering.density(e, most=10)


def test_diverse_pick():
    assert clustering.pick_diverse(["a b", "a b c", "d"], [0.9, 0.8, 0.3], most=2) == [0, 2]
    assert clustering.pick_diverse([], []) == []


def test_chunks():
    assert render.joined_blocks(["a" * 10, "b" * 10, "c" * 50], 25) == [["a" * 10, "b" * 10], ["c" * 50]]
    text = "One two. " * 30 + "\n\n" + "Short."
    parts = render.sentence_chunks(text, 100)
    assert all(len(p) <= 100 for p in parts) and "".join(parts).replace(" ", "").replace("\n", "") == text.replace(" ", "").replace("\n", "")
    assert render.sentence_chunks("short", 100) == ["short"]


def test_spoken(spark):
    md = "# T\n---\n|h|\n|---|\n|x|\n\n- item\n2. two **b** 5K `c`"
    got = spark.createDataFrame([(md,)], "t string").select(render.spoken("t")).first()[0]
    assert got == "Here's your timeline briefing.\n\nT.\n\n x.\n\n item\n two b 5 thousand c\n\nThat's your briefing for today."


def test_pages(spark, tmp_path):
    tweet = '{"__typename":"Tweet","rest_id":"7","legacy":{"id_str":"7","full_text":"hi","created_at":"","favorite_count":5},"core":{"user_results":{"result":{"core":{"name":"N","screen_name":"new"},"legacy":{"screen_name":"old","followers_count":9}}}}}'
    entry = lambda i, r: f'{{"entryId":"{i}","content":{{"itemContent":{{"tweet_results":{{"result":{r}}}}}}}}}'
    wrapped = '{"__typename":"TweetWithVisibilityResults","tweet":' + tweet.replace('"7"', '"8"') + "}"
    cursor = '{"entryId":"cursor-bottom-1","content":{"value":"next"}}'
    page = '{"data":{"home":{"home_timeline_urt":{"instructions":[{"type":"TimelineAddEntries","entries":[' + ",".join([entry("tweet-7", tweet), entry("tweet-8", wrapped), entry("promoted-9", tweet), entry("tweet-10", '{"rest_id":"10"}'), cursor]) + "]}]}}}}"
    (tmp_path / "p.json").write_text(page)
    rows = pages.entries(pages.read(spark, str(tmp_path)))
    found = sorted(pages.posts(rows, "q").collect(), key=lambda r: r["id"])
    assert [(r["id"], r["user"]["screen_name"], r["metrics"]["likes"]) for r in found] == [("7", "new", 5), ("8", "new", 5)]
    assert pages.cursors(rows).first()["cursor"] == "next"
    assert source.flat(pages.posts(rows)).count() == 2


def test_json_list_and_envelope(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id":"1","text":"x","user":{"screen_name":"s"}}]')
    (tmp_path / "b.json").write_text('{"tweets":[{"id":"2"}],"stats":{}}')
    rows = source.flat(source.read_json(spark, str(tmp_path))).orderBy("id").collect()
    assert [(r["id"], r["text"], r["likes"]) for r in rows] == [("1", "x", 0), ("2", "", 0)]
    assert source.latest(["a/2_timeline.json", "b/1_timeline.json"]) == "a/2_timeline.json"


def test_config(monkeypatch):
    got = config.queries({"defaults": {"count": 7}, "queries": [{"query": "a"}]}, {"accounts": [{"handle": "H"}, "g"]}, ["z"])
    assert [(q.label, q.count) for q in got] == [("a", 7), ("z", 100), ("from:H", 100), ("from:g", 100)]
    with pytest.raises(ValueError):
        config.queries()
    assert config.handles({"accounts": [{"handle": "H"}, "g", {}]}) == {"h", "g"}
    monkeypatch.setenv("TOKEN_X", "v")
    assert config.expanded({"a": "${TOKEN_X}", "b": ["${MISSING_X}", "c"]}) == {"a": "v", "b": ["", "c"]}


def test_sinks(spark, tmp_path):
    got = sinks.destinations({"slack": "cli"}, {"destinations": {"discord": {"webhook_url": "d"}, "discord_bridge": {"url": "b"}, "webhook": {"url": "w", "enabled": False}}}, {"WEBHOOK_URL": "env"})
    assert got == {"slack": "cli", "discord_bridge": "b"}
    sent = []
    assert sinks.post("c", "t", {"file": str(tmp_path / "d" / "x.md"), "slack": "u"}, lambda *a: sent.append(a) is None)
    assert (tmp_path / "d" / "x.md").read_text() == "c" and len(sent) == 1
    assert not sinks.post("c", "t", {}, lambda *a: True)


def test_pipeline_falls_back(spark):
    df = spark.range(3)

    def fail(_):
        raise ValueError

    p = Pipeline(("filter", fail), ("half", lambda d: d.where("id > 0")), optional=("filter",))
    assert p.run(df).count() == 2 and p.skipped == ["filter"]


def test_streaming(spark, tmp_path, sf):
    day = spark.read.parquet(f"{sf}/events.parquet").coalesce(1)
    day.unionByName(day.limit(10)).write.parquet(str(tmp_path / "in"))
    stream = events.read(spark, str(tmp_path / "in"))
    events.run_once(events.activity(events.dedup(stream, late="60 days"), late=None), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert set(spark.read.parquet(str(tmp_path / "out")).columns) == {"start", "end", "event_type", "n", "total"}


def test_bodies(spark):
    text = "a [b](https://c.example/) " + "x\n\n\n\n" * 1200
    got = spark.createDataFrame([(text,)], "text string").select(*[f("text", "T").alias(n) for n, f in sinks.PAYLOADS.items()]).first()
    for service in sinks.PAYLOADS:
        assert json.loads(sinks.body(service, text, "T")) == json.loads(got[service])
    sent = {}
    assert sinks.post(text, "T", {"slack": "u", "discord": "v", "discord_bridge": "w", "webhook": "x"}, lambda name, address, body: sent.update({name: json.loads(body)}) is None)
    assert sent["slack"]["blocks"][1]["text"]["text"].startswith("a <https://c.example/|b>") and len(sent["discord"]["embeds"][0]["description"]) <= 1900 and len(sent["discord_bridge"]["content"]) <= 2000
    audio = json.loads(spark.createDataFrame([(text,)], "text string").select(sinks.audio_payload("text", "T")).first()[0])["embeds"][0]
    assert audio["footer"]["text"] and len(audio["description"]) <= 303


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("1", "t", 2), ("2", "u", 3)], "id string, text string, n int")
    sinks.write_posts(rows, str(tmp_path / "posts"))
    assert sorted(map(tuple, spark.read.schema("id string, text string, n int").json(str(tmp_path / "posts")).collect())) == [("1", "t", 2), ("2", "u", 3)]
    sinks.write_prompts(rows.selectExpr("id AS topic", "concat('line one\nline ', text) AS prompt"), "topic", str(tmp_path / "prompts"))
    assert "".join(p.read_text() for p in (tmp_path / "prompts" / "topic=2").glob("part-*")) == "line one\nline u\n"
    sinks.write_manifest(rows.select("id", "n"), rows.agg(F.count(F.lit(1)).alias("total")), str(tmp_path / "manifest"))
    (line,) = "".join(p.read_text() for p in (tmp_path / "manifest").glob("part-*")).splitlines()
    assert json.loads(line)["stats"] == {"total": 2} and {c["id"]: c["n"] for c in json.loads(line)["clusters"]} == {"1": 2, "2": 3}


def test_synthesis_prompt():
    got = render.synthesis_prompt({"total_tweets": 3, "topic_distribution": {"ai": 2}}, ["one", "two"])
    assert "- Total tweets: 3\n" in got and '"ai": 2' in got and "\none\ntwo\n\n---\n" in got


def test_pipeline_falls_back_at_the_action(spark):
    failing = lambda d: d.withColumn("x", F.raise_error(F.lit("no")))
    p = Pipeline(("scores", failing), ("half", lambda d: d.where("id > 0")), optional=("scores",))
    assert p.run(spark.range(3)).count() == 2 and p.skipped == ["scores"]
    with pytest.raises(Exception):
        Pipeline(("scores", failing)).run(spark.range(3)).collect()


def test_encoder_is_pluggable(spark, sf):
    rows = clustering.encoded(spark.createDataFrame([("1", "ab"), ("2", None)], "id string, text string"), lambda texts: [[len(t), 1] for t in texts])
    assert {r["id"]: r["embedding"] for r in rows.collect()} == {"1": [2.0, 1.0], "2": [0.0, 1.0]}


def test_rank_of_all_rows(spark):
    rows = spark.range(1000).selectExpr("id", "id * 37 % 101 AS x")
    got = {r["id"]: r["rank"] for r in ranking.ranked(rows, [F.desc("x"), F.asc("id")]).collect()}
    assert got == {i: k for k, i in enumerate(sorted(range(1000), key=lambda i: (-(i * 37 % 101), i)), 1)}


def test_silhouette_broadcasts_no_vectors(spark, sf):
    plan = clustering.silhouette(spark.read.parquet(f"{sf}/embeddings.parquet").withColumnRenamed("label", "cluster"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastNestedLoop" not in plan and "Cartesian" not in plan


def test_streaming_counts(spark, tmp_path, sf):
    day = spark.read.parquet(f"{sf}/events.parquet").coalesce(1)
    # windows close when a much later event has come
    last = day.limit(1).selectExpr("-1L AS event_id", "ts + INTERVAL '200' DAY AS ts", "user_id", "'end' AS event_type", "value", "props")
    day.unionByName(day.limit(10)).unionByName(last).write.parquet(str(tmp_path / "in"))
    stream = events.read(spark, str(tmp_path / "in"))
    events.run_once(events.activity(events.dedup(stream, late="60 days"), late=None), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"))
    want = day.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_texts_are_searched_once_for_scores(spark, sf):
    """Neither thresholds nor scores search a text again, and posts are deduplicated once."""
    from digestlake.plans import catalog

    for name in ("strict_filter", "filter_score", "score_stats"):
        plan = catalog.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert "signup" not in plan and "breaking" not in plan and "min_by" not in plan


def test_chunks_leave_in_small_batches(spark, monkeypatch):
    import pyarrow as pa

    from digestlake.operators import render

    sizes, texts = [], ["One two three. " * 700 for _ in range(60)] + ["", None]
    monkeypatch.setattr(render, "CHUNK_CHARACTERS", 50_000)

    class Docs:
        """Gives the function that a plan would run."""

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(len(texts))]), pa.array(texts)], names=["k", "t"])
            sizes.extend(b.nbytes for b in run(iter([batch])))
            return self

        def withColumnRenamed(self, *_):
            return self

    render.chunked(Docs(), "doc_id", "text")
    assert len(sizes) > 8 and max(sizes) < 70_000
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r["doc_id"], r["n"], r["chunk"]) for r in render.chunked(rows, "doc_id", "text").collect()]
    assert sorted(got) == sorted((str(i), n, c) for i, t in enumerate(texts) for n, c in enumerate(render.sentence_chunks(t or ""), 1))
