"""The digest as one lazy plan: extract, filter, cluster or rank, render."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from digestlake.functions import scores as S
from digestlake.functions import text as T
from digestlake.operators import clustering, embedding, momentum, posts, ranking, render, scoring
from digestlake.sources.tables import written


@dataclass(frozen=True)
class Settings:
    as_of: datetime
    handles: list[str] = field(default_factory=list)
    title: str = "Digest"
    forced: list[str] = field(default_factory=list)
    max_age_hours: float = 0
    most_promo: float = 0.4
    least_news: float = 0.0
    recency_hours: float = 12
    least_accounts: int = 2
    top_entities: int = 12
    per_topic: int = 6
    other_cap: int = 8
    least_cluster: int = 5
    per_cluster: int = 100
    span: str = "last 48h"

    @classmethod
    def strict(cls, **other) -> "Settings":
        return cls(most_promo=0.3, least_news=0.15, **other)


def filtered(rows: DataFrame, s: Settings) -> DataFrame:
    """Flat posts, each once, young enough, original, scored and kept."""
    return scoring.kept(scoring.scored(posts.originals(posts.within_age(posts.dedup_first(rows), s.as_of, s.max_age_hours))), s.most_promo, s.least_news)


def by_topic(rows: DataFrame, s: Settings) -> DataFrame:
    """Numbered posts of each topic that has enough, strongest first. Topics are the costly part and are kept, since they are read twice."""
    topic = T.force_topics(T.topics("text"), s.forced)[0]
    sized = rows.withColumn("topic", topic).persist()
    big = sized.groupBy("topic").agg(F.count(F.lit(1)).alias("tweet_count")).where(F.col("tweet_count") >= s.least_cluster)
    return ranking.top_per_group(sized.join(F.broadcast(big), "topic"), ["topic"], [T.tier_rank("likes").asc(), F.desc("likes"), F.asc("_ord")], s.per_cluster)


def topic_prompts(rows: DataFrame, s: Settings) -> DataFrame:
    return render.prompts(by_topic(rows, s), "topic", F.concat(F.lit("# Topic: "), F.upper("topic")))


def stories(rows: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(accounts' posts with reliability and story, stories, momentum of all entities).

    The scored posts and their entities feed all three, so they are kept once, on disk where memory is short; a lost part is computed anew.
    """
    known = momentum.with_accounts(rows, s.handles).withColumns({"reliability": F.round(S.reliability(), 9), "entities": T.canonical_entities("text")}).persist()
    strength = momentum.aggregate(known, s.as_of, s.recency_hours)
    top = momentum.stories(strength, s.least_accounts, s.top_entities).persist()
    return momentum.assign(known, top), top, strength


def digest(rows: DataFrame, s: Settings) -> DataFrame:
    """The lines of the digest over filtered posts."""
    assigned, top, _ = stories(rows, s)
    assigned = assigned.persist()
    sources, others = momentum.story_sources(assigned, s.per_topic).persist(), momentum.other_notable(assigned, s.other_cap).persist()
    return render.digest_lines(assigned, top, sources, others, s.title, s.as_of.strftime("%Y-%m-%d %H:%M"), s.span)


def hybrid_vectors(rows: DataFrame, dims: int = 64, weight: float = 0.35) -> DataFrame:
    """(id, embedding): posts (id, text) as dense vectors of their words beside their weighted terms, brought to dims dimensions by the strongest directions of the joined matrix."""
    texts = written(rows.select("id", T.clean("text").alias("clean_text"), clustering.weighted_text("text").alias("weighted_text")), "texts")
    dense = embedding.embedded(clustering.tfidf(texts, text="clean_text"), dims=dims)
    joined, columns = embedding.hybrid(dense, clustering.tfidf(texts, text="weighted_text"), dims, weight=weight)
    sparse = written(joined, "hybrid")
    return embedding.projected(sparse, embedding.basis(sparse, columns, dims)).select("id", "embedding")


def hybrid_clusters(rows: DataFrame, least_size: int = 10, least_samples: int = 5, dims: int = 10, leaf: bool = False) -> tuple[DataFrame, DataFrame]:
    """(posts with cluster, probability and secondary clusters, vectors with cluster): words to vectors, to a manifold, to clusters by density. Posts without words have no vector and are noise."""
    vectors = written(hybrid_vectors(rows), "vectors")
    found = clustering.density(clustering.umap(vectors, "id", dims=dims), "id", "reduced", least_size, least_samples, leaf)
    points = written(vectors.join(found, "id"), "clustered")
    second = clustering.soft_assign(points, clustering.centroids(points), "id").select("id", "secondary")
    own = rows.join(points.select("id", "cluster", "probability").join(second, "id"), "id", "left")
    nobody = F.expr("cast(array() as array<int>)")
    return written(own.withColumns({"cluster": F.coalesce("cluster", F.lit(-1)), "probability": F.coalesce("probability", F.lit(0.0)), "secondary": F.coalesce("secondary", nobody)}), "grouped"), points


def hybrid_digest(rows: DataFrame, s: Settings) -> DataFrame:
    """(cluster, label, size, secondary, file, prompt) of each cluster of original posts, each post once, from their texts alone; secondary counts posts of other clusters that are nearly as close."""
    own = posts.enough(posts.originals(posts.dedup_first(rows)))
    grouped, _ = hybrid_clusters(written(own, "posts"))
    some = grouped.where("cluster <> -1").withColumn("clean_text", T.clean("text"))
    sizes = some.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    labels = written(clustering.labels(clustering.keywords(some), clustering.entity_counts(some), sizes), "labels")
    near = grouped.select(F.explode("secondary").alias("cluster")).groupBy("cluster").agg(F.count(F.lit(1)).alias("secondary"))
    best = ranking.top_per_group(some, ["cluster"], [F.desc("likes"), F.asc("_ord")], s.per_cluster).join(F.broadcast(labels), "cluster")
    asked = render.prompts(best.withColumn("named", F.struct("cluster", "label")), "named", F.concat(F.lit("# Cluster "), F.col("named.cluster").cast("string"), F.lit(": "), F.col("named.label")))
    file = F.concat(render.file_label(F.col("cluster"), F.col("label"), hybrid=True), F.lit(".txt"))
    rows = asked.select("named.*", "prompt").join(sizes, "cluster").join(near, "cluster", "left")
    return rows.select("cluster", "label", "size", F.coalesce("secondary", F.lit(0).cast("long")).alias("secondary"), file.alias("file"), "prompt")


class Pipeline:
    """Named steps from DataFrame to DataFrame.

    An optional step may fall back to its input. Since Spark fails at the action and not where a step is planned, its result
    goes through settle first, by default a cached count; a cluster may write a table there. A step that fails either way is in skipped.
    """

    def __init__(self, *steps: tuple, optional: tuple[str, ...] = (), settle=None):
        self.steps, self.optional, self.skipped, self.settle = steps, optional, [], settle or _settled

    def resumed(self, rows: DataFrame, folder: str, run_id: str, given: str = "") -> DataFrame:
        """As run, with each step's table written under folder/run_id and read back.

        A manifest is written after a table, so a run that is started again under its id goes on after the last whole step; a table without one is written anew. given names what the run works on, its
        input and settings: a manifest of another input, or of other steps before it, does not count. A skipped optional step is tried again.
        """
        spark, mark = rows.sparkSession, given
        for number, (name, step) in enumerate(self.steps):
            mark = hashlib.sha256(f"{mark}|{number}|{name}".encode()).hexdigest()
            path = f"{folder.rstrip('/')}/{run_id}/{number:02d}-{name}"
            if (known := _manifest(spark, path)) and known["mark"] == mark:
                rows = spark.read.schema(known["schema"]).parquet(f"{path}/table")
                continue
            try:
                made = step(rows)
                made.write.mode("overwrite").parquet(f"{path}/table")
            except Exception:
                if name not in self.optional:
                    raise
                self.skipped.append(name)
                mark += "-skipped"
                continue
            rows = spark.read.schema(made.schema).parquet(f"{path}/table")
            spark.createDataFrame([(mark, name, rows.count(), rows.schema.json())], MANIFEST).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
        return rows

    def run(self, rows: DataFrame) -> DataFrame:
        for name, step in self.steps:
            if name not in self.optional:
                rows = step(rows)
                continue
            try:
                rows = self.settle(step(rows))
            except Exception:
                self.skipped.append(name)
        return rows


MANIFEST = "mark string, step string, rows long, schema string"


def _manifest(spark: SparkSession, path: str) -> dict | None:
    """The mark and schema of a step whose table is whole, or None."""
    try:
        found = spark.read.schema(MANIFEST).json(f"{path}/manifest").collect()
    except AnalysisException:
        return None
    return {"mark": found[0]["mark"], "schema": StructType.fromJson(json.loads(found[0]["schema"]))} if len(found) == 1 and found[0]["schema"] else None


def _settled(rows: DataFrame) -> DataFrame:
    rows = rows.persist()
    rows.count()
    return rows
