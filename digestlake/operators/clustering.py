"""Clusters of posts and vectors: term weights, labels, centroids, soft assignment, validity, K-means and density clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from digestlake.functions import patterns as P
from digestlake.functions import text as T
from digestlake.functions import vectors as V

from digestlake.sources.tables import written

from . import manifold, neighbours, ranking


def words(text, stop: list[str] = P.STOP_WORDS) -> Column:
    """Words of at least two characters, without stop words."""
    return F.filter(F.regexp_extract_all(F.lower(T._t(text)), F.lit(f"{P.WORD}{{2,}}"), 0), lambda w: ~w.isin(stop))


def weighted_text(text="text") -> Column:
    """The text that terms are weighted in: the cleaned text, its capital entities, sorted, twice and its hashtags twice."""
    twice = lambda listed: F.flatten(F.array_repeat(listed, 2))
    return F.array_join(F.concat(F.array(T.clean(text)), twice(F.array_sort(T.capital_entities(text))), twice(T.hashtags(text))), " ")


#: Words and documents of a part, the terms of which a task numbers and counts at once.
PART_WORDS, PART_DOCS = 1 << 20, 1 << 16


def tfidf(docs: DataFrame, doc: str = "id", text: str = "text", stop: list[str] = P.STOP_WORDS, least_docs: int = 2, most_share: float = 0.8, features: int = 5000) -> DataFrame:
    """(doc, term, weight) with smoothed idf and vectors of length one, as rows and never dense.

    The vocabulary is the features most frequent terms in at least least_docs and at most most_share of the documents. Words are found once and written. Terms that cannot be among these, as their buckets say, are
    left out before they are counted one by one, and a task counts the others before they move. The vocabulary goes to every task, and a document is weighed where it lies, so that neither its terms nor its weights move. Rows that share a document are put together first, without pairs of words across them.
    """
    rows = written(docs.select(doc, words(text, stop).alias("words")), "words")
    n, found = rows.count(), rows
    if rows.groupBy(doc).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").limit(1).count():
        # a null parts the words of two rows
        found = written(rows.groupBy(doc).agg(F.flatten(F.collect_list(F.concat("words", F.array(F.lit(None).cast("string"))))).alias("words")), "documents")
    heavy = found.sparkSession.sparkContext.broadcast(_heavy(found, least_docs, most_share * n, features))
    counted = found.select("words").mapInArrow(lambda batches: _counted(batches, heavy.value), "term string, df long, total long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
    idf = _idf(counted, F.lit(n), (F.col("df") >= least_docs) & (F.col("df") <= most_share * n), features)
    listed = sorted((r["term"], r["idf"]) for r in idf.collect())  # as many as features
    known = found.sparkSession.sparkContext.broadcast(listed)
    schema = StructType([found.schema[doc], StructField("term", StringType()), StructField("weight", DoubleType())])

    def weigh(batches):
        vocabulary = _Vocabulary(known.value)
        for part in _parts(batches):
            yield vocabulary.weighed(part)

    return found.mapInArrow(weigh, schema)


def keywords(posts: DataFrame, cluster: str = "cluster", text: str = "clean_text", stop: list[str] = P.STOP_WORDS, features: int = 1000, most: int = 10) -> DataFrame:
    """The heaviest terms of each cluster, its texts taken as one document; noise (-1) has none."""
    found = posts.where(F.col(cluster) != -1).select(F.col(cluster).cast("long").alias("c"), words(text, stop + P.MARKUP_WORDS).alias("words"))
    tf = written(found.mapInArrow(_counted_by, "c long, term string, tf long").groupBy("c", "term").agg(F.sum("tf").alias("tf")), "terms")
    counted = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    # a cluster without terms counts as a document
    n = posts.where(F.col(cluster) != -1).select(F.count_distinct(cluster).alias("docs"))
    idf = written(_idf(counted.crossJoin(F.broadcast(n)), F.col("docs"), F.lit(True), features), "vocabulary")
    raw = tf.join(F.broadcast(idf), "term").select(F.col("c").cast(posts.schema[cluster].dataType).alias(cluster), "term", (F.col("tf") * F.col("idf")).alias("raw"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(cluster)))
    return ranking.top_per_group(raw.select(cluster, "term", (F.col("raw") / length).alias("weight")), [cluster], [F.desc(F.round("weight", 9)), F.asc("term")], most)


def _idf(counted: DataFrame, docs: Column, common: Column, features: int) -> DataFrame:
    """(term, idf) of the features most frequent of the counted terms (term, df, total) that are common."""
    kept = counted.where(common).orderBy(F.desc("total"), "term").limit(features)
    return kept.select("term", (F.log((1 + docs) / (1 + F.col("df"))) + 1).alias("idf"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches, the last column of which lists words, in parts of bounded size; a longer document is a part of its own."""
    for batch in batches:
        ends, lo = np.concatenate([[0], np.cumsum(_sizes(batch))]), 0
        while lo < batch.num_rows:
            hi = min(max(lo + 1, int(np.searchsorted(ends, ends[lo] + PART_WORDS, "right")) - 1), lo + PART_DOCS)
            yield batch.slice(lo, hi - lo)
            lo = hi


def _sizes(part: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(part.column(part.num_columns - 1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _terms(part: pa.RecordBatch, known: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(rows, keys, words) of all words and pairs of neighbours of a part; a key is the word's number times the base, which is one more than there are words, plus 0 or one more than the second word's number.

    Words are those of the part, or the known ones; others, and nulls, have no term and part their neighbours.
    """
    said = part.column(part.num_columns - 1).flatten().dictionary_encode()
    every, row = said.dictionary, np.repeat(np.arange(part.num_rows, dtype=np.int64), _sizes(part))
    code = pc.fill_null(said.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    if known is not None:
        number = pc.fill_null(pc.index_in(every, value_set=known), -1).to_numpy(zero_copy_only=False)
        code, every = np.append(number, -1).astype(np.int64)[code], known
    base, one = len(every) + 1, code >= 0
    two = one[:-1] & one[1:] & (row[:-1] == row[1:])
    return np.concatenate([row[one], row[:-1][two]]), np.concatenate([code[one] * base, code[:-1][two] * base + code[1:][two] + 1]), every


def _runs(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where runs of equal values begin, their lengths)"""
    at = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(sorted_) else np.zeros(0, np.int64)
    return at, np.diff(np.append(at, len(sorted_)))


def _spelt(keys: np.ndarray, words: pa.Array) -> pa.Array:
    base = len(words) + 1
    second, alone = keys % base - 1, keys % base == 0
    first = words.take(pa.array(keys // base))
    return pc.if_else(pa.array(alone), first, pc.binary_join_element_wise(first, words.take(pa.array(np.maximum(second, 0))), " "))


def _totals(rows: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, their rows, how often they occur), each key once."""
    both = np.sort(keys * n + rows)  # below 2 ** 61, as parts are bounded
    at, tf = _runs(both)
    key = both[at] // n
    first, df = _runs(key)
    return key[first], df, np.add.reduceat(tf, first) if len(first) else tf


def _counted(batches: Iterator[pa.RecordBatch], heavy: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """(term, df, total) of each part of batches (words), a row being a document; given heavy, of the terms whose bucket is marked there."""
    for part in _parts(batches):
        rows, keys, words = _terms(part)
        if heavy is not None:
            own = heavy[_buckets(keys, words)]
            rows, keys = rows[own], keys[own]
        key, df, total = _totals(rows, keys, part.num_rows)
        yield pa.RecordBatch.from_arrays([_spelt(key, words), pa.array(df, pa.int64()), pa.array(total, pa.int64())], names=["term", "df", "total"])


#: Buckets that terms fall into by a hash of their words.
BUCKETS = 1 << 20


def _buckets(keys: np.ndarray, words: pa.Array) -> np.ndarray:
    """The buckets of keys, the same wherever a term is met."""
    hashed = pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False) if len(words) else np.zeros(0, np.uint64)
    second = np.append(np.uint64(0), hashed)[keys % (len(words) + 1)]
    mixed = (hashed[keys // (len(words) + 1)] ^ (second * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(44)).astype(np.int64)  # 20 bits


def _heavy(found: DataFrame, least_docs: int, most_docs: float, features: int) -> np.ndarray:
    """Which buckets may hold one of the features most frequent terms.

    A bucket's counts are no less than those of any of its terms. What parts say of their own heaviest terms is no more than these terms' counts, so that the total of the last of as many sure ones as features is one
    that the vocabulary does not fall below. With fewer sure ones, no bucket is left out.
    """

    def bounds(batches):
        sums = np.zeros((2, BUCKETS))
        for part in _parts(batches):
            rows, keys, words = _terms(part)
            key, df, total = _totals(rows, keys, part.num_rows)
            bucket = _buckets(key, words)
            sums += np.bincount(bucket, df, BUCKETS), np.bincount(bucket, total, BUCKETS)
            best = np.argpartition(-total, features - 1)[:features] if len(total) > features else np.arange(len(total))
            yield pa.RecordBatch.from_arrays([_spelt(key[best], words), *(pa.array(x[best], pa.int64()) for x in (bucket, df, total))], names=["term", "bucket", "df", "total"])
        used = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.nulls(len(used), pa.string()), *(pa.array(x.astype(np.int64)) for x in (used, *sums[:, used]))], names=["term", "bucket", "df", "total"])

    known = written(found.select("words").mapInArrow(bounds, "term string, bucket long, df long, total long"), "bounds")
    sums = [F.sum("df").alias("df"), F.sum("total").alias("total")]
    upper = written(known.where("term is null").groupBy("bucket").agg(*sums), "buckets")
    lower = known.where("term is not null").groupBy("term", "bucket").agg(*sums)
    sure = lower.join(upper.select("bucket", F.col("df").alias("most")), "bucket").where((F.col("df") >= least_docs) & (F.col("most") <= most_docs))
    n, least = sure.orderBy(F.desc("total")).limit(features).agg(F.count(F.lit(1)), F.min("total")).first()
    kept = upper.where(F.col("total") >= (least if n == features else 0)).select("bucket")
    marked = np.zeros(BUCKETS, bool)
    marked[kept.toPandas()["bucket"].to_numpy(np.int64)] = True  # as many as buckets
    return marked


def _counted_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(c, term, tf) of each part of batches (c, words)."""
    for part in _parts(batches):
        rows, keys, words = _terms(part)
        of, group = np.unique(part.column(0).to_numpy(zero_copy_only=False), return_inverse=True)
        both = np.sort(keys * len(of) + group[rows])
        at, tf = _runs(both)
        yield pa.RecordBatch.from_arrays([pa.array(of[both[at] % len(of)], pa.int64()), _spelt(both[at] // len(of), words), pa.array(tf, pa.int64())], names=["c", "term", "tf"])


class _Vocabulary:
    """Terms with their idf, by the keys of their words."""

    def __init__(self, listed: list[tuple[str, float]]):
        self.words = pa.array(sorted({w for term, _ in listed for w in term.split(" ")}), pa.string())
        number, base = {w: i for i, w in enumerate(self.words.to_pylist())}, len(self.words) + 1
        split = [term.split(" ") for term, _ in listed]
        keys = np.array([number[w[0]] * base + (number[w[1]] + 1 if len(w) > 1 else 0) for w in split], np.int64)
        order = np.argsort(keys)
        self.keys, self.idf = keys[order], np.array([idf for _, idf in listed], float)[order]
        self.terms = pa.array([term for term, _ in listed], pa.string()).take(pa.array(order))

    def weighed(self, part: pa.RecordBatch) -> pa.RecordBatch:
        """(doc, term, weight) of a part (doc, words)."""
        rows, keys, _ = _terms(part, self.words)
        size = max(len(self.keys), 1)
        at = np.minimum(np.searchsorted(self.keys, keys), size - 1)
        own = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        both = np.sort(rows[own] * size + at[own])
        first, tf = _runs(both)
        row, term = both[first] // size, both[first] % size
        raw = tf * self.idf[term]
        weight = raw / np.sqrt(np.bincount(row, raw * raw, part.num_rows))[row]
        return pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), self.terms.take(pa.array(term)), pa.array(weight)], names=[part.schema.names[0], "term", "weight"])


def common_words(posts: DataFrame, share: float = 0.2) -> DataFrame:
    """(word): what more than a share of the posts say, a stop list that comes from the posts themselves."""
    said = posts.select(F.explode(F.array_distinct(T.label_words("text", []))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return said.crossJoin(F.broadcast(posts.agg(F.count(F.lit(1)).alias("posts")))).where(F.col("n") > share * F.col("posts")).select("word")


def label_words(posts: DataFrame, cluster: str = "cluster", stop: list[str] | DataFrame = P.STOP_WORDS) -> DataFrame:
    """(cluster, label): the three commonest words, or misc. stop is a list, or a table (word) of any length.

    posts are read once. Texts are counted by what stands between white space, and only what is left after that is trimmed and chosen from; what is no word counts under null, so that every cluster is there.
    """
    given = isinstance(stop, DataFrame)
    said = posts.select(cluster, F.explode(F.split(F.lower(T._t("text")), f"{P.BLANK}+")).alias("token")).groupBy(cluster, "token").agg(F.count(F.lit(1)).alias("n"))
    words = said.withColumn("word", T.trimmed(F.col("token"))).withColumn("word", F.when(T.labels(F.col("word"), [] if given else stop), F.col("word")))
    counts = words.groupBy(cluster, "word").agg(F.sum("n").alias("n"))
    if given:  # a stopped word is as none
        stopped = stop.select("word", F.lit(True).alias("stopped")).distinct()
        counts = counts.join(stopped, "word", "left").withColumn("word", F.when(F.col("stopped").isNull(), F.col("word")))
    best = ranking.top_per_group(counts, [cluster], [F.asc(F.col("word").isNull()), F.desc("n"), F.asc("word")], 3)
    listed = F.array_sort(F.collect_list(F.when(F.col("word").isNotNull(), F.struct("rn", "word"))))
    label = F.array_join(F.transform(listed, lambda s: s["word"]), " / ")
    return best.groupBy(cluster).agg(F.when(F.count("word") > 0, label).otherwise("misc").alias("label"))


def entity_counts(posts: DataFrame, cluster: str = "cluster", most: int = 10) -> DataFrame:
    counts = posts.where(F.col(cluster) != -1).select(cluster, F.explode(T.capital_entities("text")).alias("entity")).groupBy(cluster, "entity").agg(F.count(F.lit(1)).alias("n"))
    return ranking.top_per_group(counts, [cluster], [F.desc("n"), F.asc("entity")], most)


def by_size(posts: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(rank, cluster, n) of the clusters, the largest first; there are as many rows as clusters."""
    sizes = posts.where(F.col(cluster) != -1).groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), cluster)))


def embedded(posts: DataFrame, points: DataFrame, key: str = "vec_id", vector: str = "embedding", cluster: str = "cluster") -> DataFrame:
    """posts with their vector and cluster, by id."""
    return posts.join(points.select(F.col(key).cast("string").alias("id"), vector, cluster), "id")


def encoded(posts: DataFrame, encode, text: str = "text", vector: str = "embedding") -> DataFrame:
    """posts with the vectors that encode gives for their texts: a function from a list of texts to a list of vectors, which is called for each Arrow batch."""

    @F.pandas_udf("array<float>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[float(x) for x in v] for v in encode(texts.fillna("").tolist())])

    return posts.withColumn(vector, run(F.col(text)))


def centroids(points: DataFrame, vector: str = "embedding", cluster: str = "cluster") -> DataFrame:
    """(cluster, centroid): the mean vector at length one. Means are aggregated by place before the shuffle."""
    means = points.where(F.col(cluster) != -1).select(cluster, F.posexplode(vector).alias("at", "x")).groupBy(cluster, "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    whole = means.groupBy(cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("mean"))
    return whole.select(cluster, V.unit(F.col("mean")).alias("centroid"))


def soft_assign(points: DataFrame, centers: DataFrame, key: str = "vec_id", vector: str = "embedding", cluster: str = "cluster", least: float = 0.80, within: float = 0.03, most: int = 2) -> DataFrame:
    """(key, cluster, secondary): the other clusters that are similar or nearly as similar as the own one, best first; noise has none.

    All centroids go to every task; there are as many as clusters. Products of matrices tell which may count, and what is compared are sums in the order of the components.
    """
    got = centers.select(F.col(cluster).cast("int").alias("c"), F.col("centroid").alias("v")).orderBy("c").toArrow()
    c = got["c"].to_numpy()
    v = got["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(c), -1 if len(c) else 0)
    shared = points.sparkSession.sparkContext.broadcast((c, v))

    @F.pandas_udf("array<int>")
    def near(vectors: pd.Series, clusters: pd.Series) -> pd.Series:
        c, v = shared.value
        out: list[list[int]] = [[] for _ in range(len(vectors))]
        some = np.flatnonzero((vectors.notna() & clusters.notna() & (clusters != -1)).to_numpy())
        step = max(1, SIMILARITIES // max(1, len(c)))
        for lo in range(0, len(some) if len(c) else 0, step):
            rows = some[lo : lo + step]
            found = _similar(np.stack(vectors.iloc[rows].to_numpy()).astype(float), clusters.iloc[rows].to_numpy().astype(np.int64), c, v, least, within, most)
            for x, other in zip(*found):
                out[rows[x]].append(int(other))
        return pd.Series(out)

    nobody = F.expr("cast(array() as array<int>)")
    return points.select(key, cluster, F.when(F.col(cluster) == -1, nobody).otherwise(near(F.col(vector), F.col(cluster))).alias("secondary"))


#: Similarities of points and centroids that are held at once.
SIMILARITIES = 1 << 22


def _similar(x: np.ndarray, own: np.ndarray, c: np.ndarray, v: np.ndarray, least: float, within: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cluster) of the most similar other clusters of each row of x, best first, among clusters c, rising, with centroids v."""
    dot = lambda a, b: np.cumsum(a * b, axis=1)[:, -1]
    sims, place = x @ v.T, np.minimum(np.searchsorted(c, own), len(c) - 1)
    mine = np.flatnonzero(c[place] == own)
    home = np.zeros(len(x))
    home[mine] = dot(x[mine], v[place[mine]])
    sims[mine, place[mine]] = -np.inf
    # what products may lose
    loss = 1e-9 * (1 + np.sqrt((x * x).sum(axis=1) * (v * v).sum(axis=1).max()))
    floor = np.minimum(least, home - within) - loss
    full = np.flatnonzero((sims >= floor[:, None]).sum(axis=1) > most)
    if len(full):
        floor[full] = np.maximum(floor[full], np.partition(sims[full], len(c) - most, axis=1)[:, len(c) - most] - 2 * loss[full])
    p, q = np.nonzero(sims >= floor[:, None])
    sim = np.concatenate([np.zeros(0), *(dot(x[p[at : at + (1 << 14)]], v[q[at : at + (1 << 14)]]) for at in range(0, len(p), 1 << 14))])
    fine = (sim >= least) | (home[p] - sim <= within)
    p, q, sim = p[fine], q[fine], sim[fine]
    by = np.lexsort((c[q], -sim, p))
    p, q = p[by], q[by]
    first = np.arange(len(p)) - np.searchsorted(p, p) < most
    return p[first], c[q[first]]


#: Tasks of a silhouette, and points of a block at least.
SILHOUETTE_TASKS, SILHOUETTE_BLOCK = 48, 2048


def silhouette(points: DataFrame, key: str = "vec_id", vector: str = "embedding", cluster: str = "cluster", block: int = 256) -> DataFrame:
    """One row with the mean silhouette by Euclidean distance, noise left out, null for fewer than two clusters.

    The measure is defined over all pairs, so its work is quadratic. Points are dealt to a fixed number of tasks, each of which holds its own and streams through the blocks of every cluster in turn, so that it
    keeps a running sum for each point and no pairs; a block goes once to each task, so traffic grows with the points.
    """
    some = points.where(F.col(cluster) != -1).select(F.col(key).alias("k"), F.col(cluster).cast("int").alias("c"), F.col(vector).cast("array<double>").alias("v"))
    block = max(block, SILHOUETTE_BLOCK)
    tasks = max(1, min(SILHOUETTE_TASKS, -(-some.count() // block)))
    # as many rows as clusters, which are met by size
    parts = some.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("parts"))
    packed = [F.count(F.lit(1)).alias("n"), F.flatten(F.collect_list("v")).alias("v")]
    every = some.join(parts.hint("merge"), "c").groupBy("c", F.pmod(F.xxhash64("k"), F.col("parts")).alias("part")).agg(*packed)
    others = every.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("h"), F.lit(1).alias("kind"), "c", "part", "n", "v")
    hashed = F.xxhash64("k", F.lit(1))
    own = some.groupBy(F.pmod(hashed, F.lit(tasks)).cast("int").alias("h"), "c", F.pmod(F.shiftright(hashed, 20), F.lit(1 << 10)).alias("part")).agg(*packed)
    dealt = own.select("h", F.lit(0).alias("kind"), "c", "part", "n", "v").unionByName(others).repartitionById(tasks, F.col("h")).sortWithinPartitions("h", "kind", "c", "part")

    def sums(frames):
        held, now = [], None
        for frame in frames:
            for row in frame.itertuples(index=False):
                v = np.asarray(row.v, float).reshape(row.n, -1)
                if row.kind == 0:
                    if now is not None:  # another task's rows
                        yield now.values()
                        held, now = [], None
                    held.append((row.c, v))
                    continue
                now = now or _Silhouettes(held)
                now.add(row.c, v)
        if now is not None:
            yield now.values()

    each = dealt.mapInPandas(sums, "c int, value double")
    return each.agg(F.when(F.count_distinct("c") > 1, F.avg("value")).alias("silhouette"))


class _Silhouettes:
    """Sums of distances from points to one cluster after the other."""

    def __init__(self, held: list[tuple[int, np.ndarray]]):
        self.c, self.v = np.concatenate([np.full(len(v), c) for c, v in held]), np.concatenate([v for _, v in held])
        self.squares = (self.v * self.v).sum(axis=1)
        self.inner, self.outer = np.full(len(self.c), np.nan), np.full(len(self.c), np.inf)
        self.now, self.n, self.total = None, 0, np.zeros(len(self.c))

    def add(self, c: int, v: np.ndarray) -> None:
        """Takes a block of a cluster into account; the blocks of a cluster come one after the other."""
        if c != self.now:
            self._close()
            self.now, self.n = c, 0
            self.total[:] = 0
        self.n += len(v)
        squares = (v * v).sum(axis=1)
        columns, most = np.ascontiguousarray(-2 * v.T), squares.max(initial=0)
        # few rows at once, so that their products stay in the cache
        for lo in range(0, len(self.v), 128):
            a, s = self.v[lo : lo + 128], self.squares[lo : lo + 128]
            square = a @ columns
            square += s[:, None]
            square += squares
            # products lose digits where points are close
            close = np.flatnonzero(square < 1e-6 * (s[:, None] + most))
            if len(close):
                x, y = np.divmod(close, len(v))
                for at in range(0, len(x), 1 << 16):
                    p, q = x[at : at + (1 << 16)], y[at : at + (1 << 16)]
                    square[p, q] = ((a[p] - v[q]) ** 2).sum(axis=1)
            self.total[lo : lo + 128] += np.sqrt(square, out=square).sum(axis=1)

    def _close(self) -> None:
        if self.now is None:
            return
        mine = self.c == self.now
        if self.n > 1:
            self.inner[mine] = self.total[mine] / (self.n - 1)
        self.outer[~mine] = np.minimum(self.outer[~mine], self.total[~mine] / self.n)

    def values(self) -> pd.DataFrame:
        """(c, value) of each point: 0 for the only one of its cluster, or where all its distances are 0."""
        self._close()
        most = np.fmax(self.inner, self.outer)
        with np.errstate(invalid="ignore"):  # a single cluster has no other
            value = np.where(np.isnan(self.inner), 0.0, np.divide(self.outer - self.inner, most, out=np.zeros(len(most)), where=most > 0))
        return pd.DataFrame({"c": self.c.astype(np.int32), "value": value})


def relative_validity(points: DataFrame, key: str = "vec_id", vector: str = "embedding", cluster: str = "cluster", least_samples: int = 5, block: int = 1000) -> DataFrame:
    """One row with the density validity of the clusters over the spanning tree of all points, null without clusters."""
    rows = numbered(points, key, vector, cluster)
    edges = written(neighbours.spanning_edges(rows.select("i", "v"), rows.count(), least_samples, block), "edges")
    return neighbours.relative_validity(edges, rows.select("i", F.col(cluster).alias("cluster")))


def quality_gate(points: DataFrame, silhouettes: DataFrame, validity: DataFrame, cluster: str = "cluster") -> DataFrame:
    """One row of metrics, and whether they pass: relative validity above 0, silhouette above 0.05 and less than 35 % of noise; a metric that cannot be told is null and passes."""
    noise = F.col(cluster) == -1
    counts = points.agg(F.count_if(noise).alias("noise_count"), F.avg(noise.cast("double")).alias("noise_fraction"), F.count_distinct(F.when(~noise, F.col(cluster))).alias("n_clusters"))
    fine = F.coalesce(F.col("relative_validity") > 0, F.lit(True)) & F.coalesce(F.col("silhouette") > 0.05, F.lit(True)) & (F.col("noise_fraction") < 0.35)
    return counts.crossJoin(F.broadcast(silhouettes)).crossJoin(F.broadcast(validity)).select("relative_validity", "silhouette", "noise_fraction", "noise_count", "n_clusters", fine.alias("quality_pass"))


def kmeans(points: DataFrame, vector: str = "embedding", k: int = 20, runs: int = 10, seed: int = 42) -> DataFrame:
    """points with cluster, from the best of several seeded runs."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    ready = points.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>"))).persist()
    fits = [KMeans(k=k, seed=seed + r, featuresCol="_features", predictionCol="cluster").fit(ready) for r in range(runs)]
    best = min(fits, key=lambda m: m.summary.trainingCost)
    out = best.transform(points.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))).drop("_features")
    ready.unpersist()
    return out


def reduced(points: DataFrame, vector: str = "embedding", dims: int = 10) -> DataFrame:
    """points with reduced, the first principal components; 0 dims keeps the vector."""
    if dims == 0:
        return points.withColumn("reduced", F.col(vector).cast("array<double>"))
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    ready = points.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
    return PCA(k=dims, inputCol="_v", outputCol="_r").fit(ready).transform(ready).withColumn("reduced", vector_to_array("_r")).drop("_v", "_r")


def umap(points: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = 10, nearest: int = 15, min_dist: float = 0.0, seed: int = 42, epochs: int = 200, rounds: int = 8, block: int = 2000) -> DataFrame:
    """points with reduced, their place on a manifold of dims dimensions; 0 dims keeps the vector. Keys are unique."""
    if dims == 0:
        return reduced(points, vector, 0)
    rows = numbered(points, key, vector)
    start = reduced(rows.select("i", "v"), "v", dims).select("i", F.col("reduced").alias("y"))
    placed = manifold.reduced(rows, start, rows.count(), dims, nearest, min_dist, seed, epochs, rounds, block)
    return points.join(rows.join(placed, "i").select(F.col("k").alias(key), F.col("y").alias("reduced")), key)


def density_labels(x: np.ndarray, least_size: int, least_samples: int, leaf: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(label, probability) of points by hierarchical density clustering (Campello, Moulavi and Sander 2013); -1 is noise.

    A point counts among its own nearest neighbours. The minimum spanning tree of mutual reachability is grown a
    point at a time, so memory stays linear; then the hierarchy is condensed, and clusters are chosen by excess of mass, or the leaves.
    """
    n = len(x)
    labels, prob = np.full(n, -1), np.zeros(n)
    if n < max(2, least_size):
        return labels, prob
    squares = (x * x).sum(axis=1)
    gap = lambda i: np.sqrt(np.maximum(squares + squares[i] - 2 * (x @ x[i]), 0))
    core = np.array([np.partition(gap(i), min(least_samples, n) - 1)[min(least_samples, n) - 1] for i in range(n)])
    reach, source, done, edges, now = np.full(n, np.inf), np.zeros(n, int), np.zeros(n, bool), [], 0
    for _ in range(n - 1):
        done[now] = True
        d = np.maximum(np.maximum(gap(now), core), core[now])
        closer = ~done & (d < reach)
        reach[closer], source[closer] = d[closer], now
        now = int(np.argmin(np.where(done, np.inf, reach)))
        edges.append((reach[now], source[now], now))
    return condensed(n, edges, least_size, leaf)


def condensed(n: int, edges: list[tuple[float, int, int]], least_size: int, leaf: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(label, probability) of n points from the n - 1 edges (distance, point, point) of their spanning tree."""
    labels, prob = np.full(n, -1), np.zeros(n)
    if n < max(2, least_size):
        return labels, prob
    # single linkage: node n + k joins the two sides of the k-th shortest edge
    edges = sorted(edges)
    up, top, size, sides, level = list(range(n)), list(range(n)), [1] * n, [], []
    for w, a, b in edges:
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        while up[b] != b:
            up[b] = up[up[b]]
            b = up[b]
        sides.append((top[a], top[b]))
        level.append(1 / w if w > 0 else np.inf)
        size.append(size[top[a]] + size[top[b]])
        up[b] = a
        top[a] = n + len(sides) - 1

    def leaves(node: int) -> list[int]:
        out, todo = [], [node]
        while todo:
            k = todo.pop()
            if k < n:
                out.append(k)
            else:
                todo += sides[k - n]
        return out

    # condensed: clusters with birth, members' departures and children
    birth, falls, children = {0: 0.0}, {0: []}, {0: []}
    todo = [(n + len(sides) - 1, 0)]
    while todo:
        node, c = todo.pop()
        if node < n:
            falls[c].append((node, birth[c]))
            continue
        a, b = sides[node - n]
        lam = level[node - n]
        big = [s for s in (a, b) if size[s] >= least_size]
        if len(big) == 2:
            for s in big:
                k = len(birth)
                birth[k], falls[k], children[k] = lam, [], []
                children[c].append((k, lam, size[s]))
                todo.append((s, k))
        else:
            for s in (a, b):
                if s in big:
                    todo.append((s, c))
                else:
                    falls[c] += [(p, lam) for p in leaves(s)]
    cap = max([v for v in level if np.isfinite(v)], default=1.0)
    stable = {c: sum(min(v, cap) - min(birth[c], cap) for _, v in falls[c]) + sum((min(v, cap) - min(birth[c], cap)) * s for _, v, s in children[c]) for c in birth}
    chosen: set[int] = set()

    def under(c: int) -> list[int]:
        out, todo = [], [c]
        while todo:
            k = todo.pop()
            out.append(k)
            todo += [x for x, _, _ in children[k]]
        return out

    for c in sorted(birth, reverse=True):
        if c == 0:
            continue
        below = sum(stable[k] for k, _, _ in children[c])
        if not children[c] or (not leaf and stable[c] >= below):
            chosen -= set(under(c))
            chosen.add(c)
        elif not leaf:
            stable[c] = below
    for number, c in enumerate(sorted(chosen)):
        members = [p for k in under(c) for p in falls[k]]
        most = max(min(v, cap) for _, v in members)
        for p, v in members:
            labels[p], prob[p] = number, min(v, cap) / most if most > 0 else 1.0
    return labels, prob


def numbered(points: DataFrame, key: str = "vec_id", vector: str = "embedding", *more: str) -> DataFrame:
    """(i, k, v) of points, numbered from 0 in the order of their key. Stored."""
    rows = points.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"), *more)
    return written(ranking.ranked(rows, [F.asc("k")], "i").withColumn("i", F.col("i") - 1), "numbered")


def density(points: DataFrame, key: str = "vec_id", vector: str = "embedding", least_size: int = 10, least_samples: int = 5, leaf: bool = False, most: int | None = None, block: int = 1000) -> DataFrame:
    """(key, cluster, probability) by density; a set of more than most points is refused, where most is given.

    The spanning tree is built from blocks that are near each other, over all tasks. Its n - 1 edges, and no vectors, are then condensed by one task.
    """
    n = points.count()
    if most is not None and n > most:
        raise ValueError(f"{n} points; density clustering takes {most} at most: reduce the set first")
    rows = numbered(points, key, vector)
    edges = neighbours.spanning_edges(rows.select("i", "v"), n, least_samples, block)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        label, prob = condensed(n, list(zip(frame["w"].tolist(), frame["u"].tolist(), frame["v"].tolist())), least_size, leaf)
        return pd.DataFrame({"i": np.arange(n), "cluster": label.astype("int32"), "probability": prob})

    found = edges.withColumn("g", F.lit(0)).groupBy("g").applyInPandas(run, "i long, cluster int, probability double")
    nothing = F.coalesce("cluster", F.lit(-1)).alias("cluster"), F.coalesce("probability", F.lit(0.0)).alias("probability")
    return rows.join(found, "i", "left").select(F.col("k").alias(key), *nothing)


def pick_diverse(terms: list[str], scores: list[float], balance: float = 0.5, most: int = 5) -> list[int]:
    """Places of terms by maximal marginal relevance: score against the largest overlap of words with those picked; the first of equals wins."""
    words = [set(t.lower().split()) for t in terms]
    overlap = lambda a, b: len(words[a] & words[b]) / max(len(words[a]), len(words[b])) if words[a] and words[b] else 0.0
    left, out = list(range(len(terms))), []
    while left and len(out) < most:
        value = (lambda i: balance * scores[i] - (1 - balance) * max(overlap(i, j) for j in out)) if out else (lambda i: scores[i])
        best = max(left, key=value)
        left.remove(best)
        out.append(best)
    return out


def labels(keyword_rows: DataFrame, entities: DataFrame, sizes: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, label): the leading entity if more than 30 % of the posts name it, with the first keyword; else three diverse keywords; else cluster_N."""

    def pick(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rn")
        terms = frame["term"].tolist()
        return pd.DataFrame({"c": [int(frame["c"].iloc[0])], "picked": [[terms[i] for i in pick_diverse(terms, frame["weight"].tolist())]]})

    picked = keyword_rows.select(F.col(cluster).cast("int").alias("c"), "rn", "term", "weight").groupBy("c").applyInPandas(pick, "c int, picked array<string>")
    lead = entities.where("rn = 1").select(F.col(cluster).alias("c"), "entity", "n")
    every = sizes.select(F.col(cluster).alias("c"), "size").join(picked, "c", "left").join(lead, "c", "left")
    some = F.coalesce(F.size("picked"), F.lit(0)) > 0
    label = F.when(some & (F.col("n") / F.col("size") > 0.3), F.concat("entity", F.lit(": "), F.get("picked", F.lit(0)))).when(some, F.array_join(F.slice("picked", 1, 3), " / ")).otherwise(F.concat(F.lit("cluster_"), F.col("c").cast("string")))
    return every.select(F.col("c").alias(cluster), label.alias("label"))
