"""Registry of the named queries over the driver's tables. Each applies an operator to its whole table; plans.oracle has the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestlake.functions import scores as S
from digestlake.functions import text as T
from digestlake.functions import vectors as V
from digestlake.operators import clustering, momentum, neighbours, posts, ranking, render, scoring
from digestlake.operators import embedding as vectors_of
from digestlake.sources import pages, replay, sinks, tables
from digestlake.sources import posts as source

from . import oracle
from .pipeline import Settings, by_topic, digest, filtered, hybrid_digest, stories, topic_prompts

SETTINGS = Settings(as_of=datetime(2024, 1, 4), handles=["src0", "src3", "src7"], title="Digest")
STRICT = Settings.strict(as_of=datetime(2024, 1, 4), handles=SETTINGS.handles)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(f: Callable) -> Callable:
    """Registers f(posts) under its name, given the posts view."""
    _QUERIES[f.__name__] = lambda spark, sf_dir: f(source.view(spark, sf_dir))
    return f


def _table(name: str):
    def register(f: Callable) -> Callable:
        _QUERIES[f.__name__] = lambda spark, sf_dir: f(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        return f

    return register


def _joined(name: str, column) -> Callable:
    """A query (id, name) of an array of strings in one text."""
    _QUERIES[name] = lambda spark, sf_dir: source.view(spark, sf_dir).select("id", F.array_join(column("text"), "|").alias(name))
    return column


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return oracle.queries()


# -- posts ----------------------------------------------------------------------------------------


@_query
def dedup_first(p):
    return posts.dedup_first(source.with_copies(p)).select("id", "_query", "likes")


@_query
def dedup_provenance(p):
    return posts.dedup_provenance(source.with_copies(p)).select("id", "_query", "likes")


@_query
def union_queries(p):
    return source.with_copies(p).groupBy("_query").agg(F.count(F.lit(1)).alias("n"))


@_query
def age_filter(p):
    return posts.within_age(p, SETTINGS.as_of, 48).select("id", "created_at")


@_query
def originals(p):
    return posts.originals(p).select("id")


@_query
def search_filters(p):
    return posts.search(p, least_likes=1000, links=True, replies=False).select("id", "likes")


@_query
def parse_ts(p):
    return p.select("id", T.parsed_time("created_at").cast("timestamp_ntz").alias("parsed"))


for _name, _column in {"hashtags": T.hashtags, "mentions": T.mentions, "urls": T.urls, "cashtags": T.cashtags, "topics_text": T.topics, "news_entities": T.news_entities}.items():
    _joined(_name, _column)
_joined("cap_entities", lambda t: F.array_sort(T.capital_entities(t)))
_joined("canonical_entities", lambda t: F.array_sort(T.canonical_entities(t)))


@_query
def clean_text(p):
    return p.select("id", T.clean("text").alias("clean_text"))


@_query
def companies_products(p):
    return p.select("id", F.array_join(T.named("text", T.P.COMPANIES), "|").alias("companies"), F.array_join(T.named("text", T.P.PRODUCTS), "|").alias("products"))


@_query
def enrich_force(p):
    e = posts.enrich(p, ["finance", "crypto"])
    return e.select("id", F.array_join("extracted.topics", "|").alias("topics"), "extracted.engagement_tier", "extracted.content_type", F.array_join("extracted.entities.companies", "|").alias("companies"))


@_query
def primary_topic(p):
    return posts.originals(p).groupBy(T.topics("text")[0].alias("topic")).agg(F.count(F.lit(1)).alias("n"))


@_query
def topic_distribution(p):
    return posts.distribution(posts.originals(p), T.topics("text"), "topic", several=True)


@_query
def tier_distribution(p):
    return posts.distribution(posts.originals(p), T.tier("likes"), "tier")


@_query
def content_type_distribution(p):
    return posts.distribution(p, T.content_type("text", "is_retweet", "is_quote"), "content_type")


@_query
def topic_share(p):
    some = posts.originals(p)
    return posts.share(posts.distribution(some, T.topics("text"), "topic", several=True), some)


@_query
def corpus_stats(p):
    return posts.corpus_stats(p)


# -- scores ---------------------------------------------------------------------------------------


@_query
def promo_score(p):
    return p.select("id", F.round(S.promo(), 3).alias("promo_score"))


@_query
def corroboration(p):
    return scoring.corroboration(posts.originals(p))


@_query
def news_score(p):
    return scoring.scored(posts.originals(p)).select("id", "corroboration", "news_score")


@_query
def filter_score(p):
    rows = filtered(p, SETTINGS)
    return rows.select("id", "promo_score", "news_score", F.round(F.col("news_score") - 0.5 * F.col("promo_score"), 6).alias("composite"))


@_query
def ranked_posts(p):
    return scoring.ranked(filtered(p, SETTINGS).select("id", "_ord", "news_score", "promo_score")).select("rank", "id", "composite")


@_query
def strict_filter(p):
    return filtered(p, STRICT).select("id", "promo_score", "news_score")


@_query
def filter_counters(p):
    return scoring.counters(scoring.scored(posts.originals(p)), 0.3, 0.15)


@_query
def score_stats(p):
    return scoring.score_stats(scoring.scored(posts.originals(p)))


@_query
def top_newsworthy(p):
    rows = filtered(p, SETTINGS)
    return ranking.top(rows, [F.desc(F.col("news_score") - 0.5 * F.col("promo_score")), F.asc("_ord")], 10).select("id", "news_score", "promo_score")


@_query
def topk_likes(p):
    return ranking.top(p, [F.desc("likes"), F.asc("_ord")], 5).select("id", "likes")


# -- topics and prompts ---------------------------------------------------------------------------


@_query
def prioritised(p):
    return by_topic(posts.originals(p), SETTINGS).select("topic", F.col("rn").cast("bigint").alias("rn"), "id", "tweet_count")


@_query
def topic_prompt(p):
    return topic_prompts(posts.originals(p), SETTINGS)


@_query
def topic_manifest(p):
    rows = by_topic(posts.originals(p), SETTINGS)
    return rows.groupBy("topic").agg(F.max("tweet_count").alias("tweet_count"), F.count(F.lit(1)).alias("prioritized_count"), F.concat(F.first("topic"), F.lit(".txt")).alias("file"))


# -- digest ---------------------------------------------------------------------------------------


def _known(p):
    return momentum.with_accounts(scoring.scored(posts.originals(p)), SETTINGS.handles)


@_query
def momentum_entities(p):
    out = momentum.aggregate(momentum.with_accounts(posts.originals(p), SETTINGS.handles), SETTINGS.as_of, SETTINGS.recency_hours)
    return out.withColumn("momentum", F.round("momentum", 6))


@_query
def reliability(p):
    return _known(p).select("id", F.col("trusted"), F.round(S.reliability(), 6).alias("reliability"))


@_query
def top_stories(p):
    _, top, _ = stories(filtered(p, SETTINGS), SETTINGS)
    return top.select(F.col("story").cast("bigint").alias("story"), "entity", "tweets", "quality", F.round("momentum", 6).alias("momentum"))


@_query
def story_assignment(p):
    assigned, _, _ = stories(filtered(p, SETTINGS), SETTINGS)
    return assigned.where("story is not null").select("id", "story_entity")


@_query
def story_sources(p):
    assigned, _, _ = stories(filtered(p, SETTINGS), SETTINGS)
    return momentum.story_sources(assigned).select("story_entity", F.col("rn").cast("bigint").alias("rn"), "id")


@_query
def other_notable(p):
    assigned, _, _ = stories(filtered(p, SETTINGS), SETTINGS)
    return momentum.other_notable(assigned).select(F.col("rn").cast("bigint").alias("rn"), "id")


@_query
def digest_lines(p):
    return digest(filtered(p, SETTINGS), SETTINGS)


# -- clusters -------------------------------------------------------------------------------------


def _by_topic(p):
    """Posts with the topic's place in the catalogue as cluster, general as noise."""
    topic = T.topics("text")[0]
    place = F.coalesce(F.try_element_at(T.literal_map({t: i for i, t in enumerate(T.P.TOPICS)}), topic), F.lit(-1))
    return posts.originals(p).withColumn("cluster", place)


def _clustered(p):
    """The same with cleaned texts, kept for queries that read them more than once."""
    return _by_topic(p).withColumn("clean_text", T.clean("text")).persist()


@_query
def label_words(p):
    return clustering.label_words(_by_topic(p))


@_query
def label_words_listed(p):
    """Labels by a stop list in a table, here of the words that a fifth of the posts have in common."""
    rows = _clustered(p)
    return clustering.label_words(rows, stop=clustering.common_words(rows))


@_query
def cluster_entities(p):
    return clustering.entity_counts(_by_topic(p)).select("cluster", F.col("rn").cast("bigint").alias("rn"), "entity", "n")


@_query
def cluster_tiers(p):
    t = T.tier("likes")
    return _by_topic(p).groupBy("cluster").agg(*[F.count_if(t == name).alias(name) for name in ("viral", "high", "medium", "low")])


@_query
def cluster_manifest(p):
    best = F.max_by(F.struct("screen_name", "likes", "id"), F.struct("likes", -F.col("_ord")))
    rows = _clustered(p)
    sized = rows.where("cluster <> -1").groupBy("cluster").agg(F.count(F.lit(1)).alias("tweet_count"), best.alias("b"))
    labelled = sized.join(clustering.label_words(rows), "cluster")
    return labelled.select("cluster", "label", "tweet_count", F.least("tweet_count", F.lit(100)).cast("bigint").alias("prioritized_count"), F.concat(render.file_label(F.col("cluster"), F.col("label")), F.lit(".txt")).alias("file"), F.col("b.screen_name").alias("top_user"), F.col("b.likes").alias("top_likes"), F.col("b.id").alias("top_id"))


@_query
def cluster_prompt(p):
    rows = ranking.top_per_group(_clustered(p).where("cluster <> -1"), ["cluster"], [F.desc("likes"), F.asc("_ord")], 100)
    return render.prompts(rows, "cluster", F.concat(F.lit("# Cluster "), F.col("cluster").cast("string"), F.lit(": topic")))


@_query
def clusters_by_size(p):
    return clustering.by_size(_by_topic(p)).select(F.col("rank").cast("bigint").alias("rank"), "cluster", "n")


@_query
def corpus_guard(p):
    """All posts, and too few of them."""
    own = posts.originals(p)
    few = ranking.top(own, [F.desc("likes"), F.asc("_ord")], 19)
    return posts.enough(own).select("id", F.lit("all").alias("of")).unionByName(posts.enough(few).select("id", F.lit("few").alias("of")))


@_query
def hybrid_files(p):
    return clustering.label_words(_by_topic(p)).where("cluster <> -1").select("cluster", F.concat(render.file_label(F.col("cluster"), F.col("label"), hybrid=True), F.lit(".txt")).alias("file"))


@_query
def viral_prompt(p):
    viral = ranking.numbered(_clustered(p).where("cluster = -1 and likes >= 5000"), [F.desc("likes"), F.asc("_ord")], 20)
    return render.highlights(viral)


@_query
def noise_prompt(p):
    notable = ranking.numbered(_clustered(p).where("cluster = -1 and likes >= 1000"), [F.desc("likes"), F.asc("_ord")], 50)
    return render.prompts(notable, "cluster", F.lit("# Cluster -1: uncategorized (noise)")).select("n", "prompt")


@_query
def views_cast(p):
    said = F.when(F.col("likes") % 3 == 0, F.lit(None)).when(F.col("likes") % 3 == 1, F.col("likes").cast("string")).otherwise(F.concat(F.col("likes").cast("string"), F.lit("k")))
    return p.select("id", T.views(said).alias("views"))


def _with_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.embedded(source.view(spark, sf_dir), _points(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


def cluster_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_vectors(spark, sf_dir).select("id", "cluster", "screen_name", "likes", F.round(V.norm(F.col("embedding")), 4).alias("length"))


def vector_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranking.top_per_group(posts.originals(_with_vectors(spark, sf_dir)).where("cluster <> -1"), ["cluster"], [F.desc("likes"), F.asc("_ord")], 100)
    return render.prompts(rows, "cluster", F.concat(F.lit("# Cluster "), F.col("cluster").cast("string"), F.lit(": vectors")))


_QUERIES |= {"cluster_vectors": cluster_vectors, "vector_prompts": vector_prompts}


@_query
def noise_viral(p):
    rows = _clustered(p).where("cluster = -1")
    notable = ranking.numbered(rows.where("likes >= 1000"), [F.desc("likes"), F.asc("_ord")], 50).withColumn("kind", F.lit("notable"))
    viral = ranking.numbered(rows.where("likes >= 5000"), [F.desc("likes"), F.asc("_ord")], 20).withColumn("kind", F.lit("viral"))
    return notable.unionByName(viral).select("kind", F.col("rn").cast("bigint").alias("rn"), "id", "likes")


@_query
def tfidf(p):
    return clustering.tfidf(posts.originals(p).withColumn("clean_text", T.clean("text")), text="clean_text").select("id", "term", F.round("weight", 6).alias("weight"))


@_query
def tfidf_weighted(p):
    rows = posts.originals(p).withColumn("weighted_text", clustering.weighted_text("text"))
    return clustering.tfidf(rows, text="weighted_text").select("id", "term", F.round("weight", 6).alias("weight"))


@_query
def ctfidf(p):
    return clustering.keywords(_clustered(p)).select("cluster", F.col("rn").cast("bigint").alias("rn"), "term", F.round("weight", 6).alias("weight"))


@_query
def mmr_labels(p):
    rows = _clustered(p)
    sizes = rows.where("cluster <> -1").groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    return clustering.labels(clustering.keywords(rows), clustering.entity_counts(rows), sizes)


def _points(e):
    return e.withColumnRenamed("label", "cluster")


@_table("embeddings")
def centroids(e):
    return clustering.centroids(_points(e)).select("cluster", F.posexplode("centroid").alias("place", "x")).select("cluster", F.col("place").cast("bigint").alias("place"), F.round("x", 6).alias("x"))


@_table("embeddings")
def soft_assign(e):
    points = _points(e)
    out = clustering.soft_assign(points, clustering.centroids(points), least=0.5)
    return out.select("vec_id", "cluster", F.array_join(F.transform("secondary", lambda c: c.cast("string")), "|").alias("secondary"))


@_table("embeddings")
def secondary_clusters(e):
    """By the default thresholds, which few vectors of these tables reach."""
    points = _points(e)
    out = clustering.soft_assign(points, clustering.centroids(points))
    return out.select("vec_id", "cluster", F.array_join(F.transform("secondary", lambda c: c.cast("string")), "|").alias("secondary"))


@_table("embeddings")
def silhouette(e):
    return clustering.silhouette(_points(e)).select(F.round("silhouette", 6).alias("silhouette"))


@_table("embeddings")
def relative_validity(e):
    return clustering.relative_validity(_points(e)).select(F.round("relative_validity", 6).alias("relative_validity"))


@_table("embeddings")
def core_distances(e):
    rows = clustering.numbered(e)
    cores, _ = neighbours.core_distances(neighbours.grid(rows, rows.count(), 1000), 5)
    return rows.join(cores, "i").select(F.col("k").alias("vec_id"), F.round("core", 6).alias("core"))


@_table("embeddings")
def quality_gate(e):
    points = _points(e)
    gate = clustering.quality_gate(points, clustering.silhouette(points), clustering.relative_validity(points))
    return gate.select(F.round("relative_validity", 6).alias("relative_validity"), F.round("silhouette", 6).alias("silhouette"), F.round("noise_fraction", 6).alias("noise_fraction"), "noise_count", "n_clusters", "quality_pass")


@_table("embeddings")
def kmeans(e):
    return clustering.kmeans(e.select("vec_id", "embedding")).select("vec_id", "cluster")


@_table("embeddings")
def hdbscan(e):
    return clustering.density(clustering.reduced(e.select("vec_id", "embedding")), vector="reduced")


@_table("embeddings")
def umap(e):
    return clustering.umap(e.select("vec_id", "embedding")).select("vec_id", F.transform("reduced", lambda x: F.round(x, 6)).alias("reduced"))


@_query
def embedding(p):
    weights = clustering.tfidf(posts.originals(p).withColumn("clean_text", T.clean("text")), text="clean_text")
    return vectors_of.embedded(weights).select("id", F.size("embedding").cast("bigint").alias("dims"), F.transform("embedding", lambda x: F.round(x, 6)).alias("embedding"))


@_query
def hybrid_clusters(p):
    return hybrid_digest(p, SETTINGS)


@_table("embeddings")
def pca(e):
    return clustering.reduced(e.select("vec_id", "embedding")).select("vec_id", F.transform("reduced", lambda x: F.round(x, 6)).alias("reduced"))


@_table("embeddings")
def hybrid_vector(e):
    v = V.hybrid(F.col("embedding"), F.slice("embedding", 1, 8))
    return e.select("vec_id", F.size(v).cast("bigint").alias("dims"), F.round(V.norm(v), 6).alias("length"), F.round(V.dot(F.slice(v, 1, 64), F.col("embedding")), 5).alias("along"))


# -- captured pages -------------------------------------------------------------------------------


def _captured(p: DataFrame, search: bool = False) -> DataFrame:
    """(page, text): pages of 25 posts as they are captured; some results are wrapped, names are in either place, and other entries are among them."""
    at = "if(_ord % 2 = 0, screen_name, null)"
    tweet = f"""to_json(named_struct('__typename', 'Tweet', 'rest_id', id, 'legacy', named_struct('id_str', id, 'full_text', text, 'created_at', created_at, 'favorite_count', likes),
      'core', named_struct('user_results', named_struct('result', named_struct('core', named_struct('name', {at}, 'screen_name', {at}), 'legacy', named_struct('screen_name', screen_name, 'followers_count', followers), 'is_blue_verified', verified)))))"""
    wrapped = """concat(if(_ord % 5 = 0, '{"__typename":"TweetWithVisibilityResults","tweet":', ''), tweet, if(_ord % 5 = 0, '}', ''))"""
    content = """concat('{"itemContent":{"tweet_results":{"result":', result, '}}}')"""
    rows = p.selectExpr("_ord", "id", "_ord div 25 as page", f"{tweet} as tweet").selectExpr("*", f"{wrapped} as result").selectExpr("*", f"{content} as content")
    listed = lambda condition, entry: f"array_join(transform(array_sort(collect_list(if({condition}, struct(_ord, {entry} as e), null))), x -> x.e), ',')"
    entry = """concat('{"entryId":"', if(_ord % 10 = 3, 'promoted-', 'tweet-'), id, '","content":', content, '}')"""
    item = """concat('{"entryId":"tweet-', id, '","item":', content, '}')"""
    end = """concat('{"entryId":"cursor-bottom-', page, '","content":{"value":"next-', page, '"}}')"""
    grouped = rows.groupBy("page").agg(F.expr(listed("_ord % 4 <> 1" if search else "true", entry)).alias("entries"), F.expr(listed("_ord % 4 = 1", item)).alias("items"))
    added = f"""concat('{{"type":"TimelineAddEntries","entries":[', entries, if(entries = '', '', ','), {end}, ']}}')"""
    if not search:
        return grouped.selectExpr("page", f"""concat('{{"data":{{"home":{{"home_timeline_urt":{{"instructions":[', {added}, ']}}}}}}}}') as text""")
    module = """concat('{"type":"TimelineAddToModule","moduleItems":[', items, ']}')"""
    return grouped.selectExpr("page", f"""concat('{{"data":{{"search_by_raw_query":{{"search_timeline":{{"timeline":{{"instructions":[', {added}, ',', {module}, ']}}}}}}}}}}') as text""")


def _page_posts(p: DataFrame, search: bool) -> DataFrame:
    nested = pages.posts(pages.entries(pages.parse(_captured(p, search))), "captured")
    return source.flat(nested).select("id", "text", "created_at", "screen_name", "verified", "followers", "likes", "_query")


def _feeds(p: DataFrame) -> DataFrame:
    """(feed, page, cursor, text) of three feeds of captured pages, each page naming the cursor that the next one is asked with."""
    numbered = p.withColumn("_ord", F.expr("_ord div 3"))
    each = [_captured(numbered.where(F.col("_query") == feed)).withColumn("feed", F.lit(feed)) for feed in ("q0", "q1", "q2")]
    return reduce(DataFrame.unionByName, each).withColumn("cursor", F.when(F.col("page") > 0, F.concat(F.lit("next-"), (F.col("page") - 1).cast("string"))))


@_query
def timeline_replay(p):
    """Feeds that are written as pages and followed from cursor to cursor."""
    path = tables.folder(p.sparkSession, "feeds")
    replay.capture(_feeds(p), path)
    followed = replay.read(p.sparkSession, path, target=1 << 40)
    found = pages.entries(pages.parse(followed.withColumn("page", F.struct("feed", "page"))))
    named = pages.posts(found, None).withColumn("_query", F.col("_ord.page.feed"))
    return source.flat(named).select("id", "text", "screen_name", "likes", "_query")


@_query
def timeline_posts(p):
    return _page_posts(p, False)


@_query
def search_posts(p):
    return _page_posts(p, True)


@_query
def page_cursors(p):
    return pages.cursors(pages.entries(pages.parse(_captured(p))))


# -- documents ------------------------------------------------------------------------------------


@_query
def slack_links(p):
    linked = F.concat(F.lit("[source](https://x.example/"), "id", F.lit(") "), "text", F.lit(" [no](http://plain)"))
    return p.select("id", T.slack_links(linked).alias("linked"))


@_table("documents")
def truncate(d):
    return d.select("doc_id", T.truncated("text", 3500).alias("slack"), T.truncated("text", 1900).alias("discord"))


@_table("documents")
def sanitize(d):
    spaced = F.replace(F.col("text"), F.lit(". "), F.lit("\n\n\n\n"))
    return d.select("doc_id", T.sanitized(spaced).alias("clean"))


@_table("documents")
def chunk_3500(d):
    return render.fixed_chunks(d, "doc_id", "text")


@_table("documents")
def chunks(d):
    return render.chunked(d, "doc_id", "text")


@_table("documents")
def batches(d):
    return render.chunked(d.withColumn("text", F.replace("text", F.lit("\n"), F.lit("\n\n"))), "doc_id", "text", by_sentence=False)


@_query
def spoken_script(p):
    md = F.concat(F.lit("# Post "), "id", F.lit("\n---\n## By **"), "screen_name", F.lit("**\n- [link](https://a.example) 5K likes\n1. one\n| h | k |\n|---|---|\n| a | "), F.col("likes").cast("string"), F.lit(" |\n\n"), "text")
    return p.select("id", render.spoken(md).alias("script"))


@_query
def payloads(p):
    return p.select("id", sinks.slack_payload("text", "Digest").alias("slack"), sinks.discord_payload("text", "Digest").alias("discord"), sinks.webhook_payload("text", "Digest").alias("webhook"), sinks.audio_payload("text", "Digest").alias("audio"))
