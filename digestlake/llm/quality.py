"""Quality rules with cross-document line frequency, in DataFrame and SQL functions only.

Base rules look at one text: too few words, or too large a share of words in repeated 8-word windows. The method then
looks across documents: lines are normalised (white space collapsed, lower case) and hashed; the distinct texts
that hold a line are counted for each host; lines above the host's limit are removed; a document that loses more
than its share of words is rejected as depleted. judge gives the figures of each row, remaining its text without those lines.

Texts are never exploded into words: windows are hashed inside the row, by doubling (two words, four, eight).
Line counts go through two aggregations, first by line and text and then by line, so that no key gathers its rows
in one task. Copies of one text count once; with documents, every document counts.

Defined results: a null text has no words and fails; a null host is a host of its own; null doc_ids and repeated rows
are judged like others; very long texts are read whole; an empty table gives no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import join_hot, stored

SPACE = r"[\\x20\\x09-\\x0D]+"
WINDOW = 8


def _let(value: str, name: str, body: str) -> str:
    """body with name bound to value, computed once for the row."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _zip(a: str, n: str, step: int, body: str) -> str:
    """body(x, y) over the pairs (a[i], a[i + step]), of which there are n."""
    return f"zip_with(slice({a}, 1, {n}), slice({a}, {1 + step}, {n}), (x, y) -> {body})"


def _repeated_words(hashes: str) -> str:
    """SQL for the number of words in windows that occur twice or more among the words' hashes."""
    pair = "xxhash64(x, y)"
    windows = _let(_zip("h", "size(h) - 1", 1, pair), "a", _let(_zip("a", "size(a) - 2", 2, pair), "b", _zip("b", "size(b) - 4", 4, pair)))
    # hash and place sorted by hash: neighbours of equal hash are repeated windows
    places = _let("sort_array(transform(w, (x, i) -> struct(x as h, i as i)))", "s", f"sort_array(array_distinct(flatten(filter({_zip('s', 'size(s) - 1', 1, 'if(x.h = y.h, array(x.i, y.i), null)')}, p -> p is not null))))")
    covered = f"aggregate({_zip('p', 'size(p) - 1', 1, f'least({WINDOW}, y - x)')}, {WINDOW}, (s, x) -> s + x)"
    found = _let(windows, "w", f"if(size(array_distinct(w)) = size(w), 0, {_let(places, 'p', covered)})")
    return f"if(size({hashes}) <= {WINDOW}, 0, {_let(hashes, 'h', found)})"


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The figures of each text by itself, and its lines as (hash, words)."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("-")).alias("host"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    hashed = rows.selectExpr(
        "doc_id", "host", "text",
        f"transform(filter(split(text, '{SPACE}'), x -> x <> ''), x -> xxhash64(x)) as hashes",
        "filter(split(text, '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]') as lines",
        "filter(transform(split(lower(regexp_replace(text, '[\\\\x20\\\\x09\\\\x0B-\\\\x0D]+', ' ')), '\\n'), x -> trim(x)), x -> x <> '') as plain",
    )
    return hashed.selectExpr(
        "doc_id", "host", "xxhash64(text) as digest",
        "cast(size(hashes) as bigint) as n_words",
        f"cast(length(regexp_replace(text, '{SPACE}', '')) as bigint) as word_chars",
        "cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '')) as bigint) as n_symbols",
        "cast(size(lines) - size(array_distinct(lines)) as bigint) as n_dup_lines",
        f"cast({_repeated_words('hashes')} as bigint) as n_repeat_words",
        "transform(plain, x -> struct(xxhash64(x) as line, length(x) - length(replace(x, ' ', '')) + 1 as words)) as lines",
    )


def common_lines(measured: DataFrame, least_docs: int = 10, share: float = 0.01, documents: bool = False) -> DataFrame:
    """(host, line, n) of the lines in more than least_docs distinct texts and more than that share of the host's distinct texts; with documents, of its distinct doc_ids instead, all null ones being one."""
    unit = F.coalesce(F.col("doc_id").cast("string"), F.lit("")) if documents else F.col("digest")
    counted = measured.select("host", unit.alias("unit"), "lines")
    units = counted.groupBy("host", "unit").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count(F.lit(1)).alias("units"))
    carried = counted.select("host", "unit", F.explode(F.array_distinct(F.col("lines.line"))).alias("line"))
    counts = carried.groupBy("host", "line", "unit").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least_docs)
    return counts.join(units, "host").where(F.col("n") > share * F.col("units")).select("host", "line", "n")


def _lost(measured: DataFrame, least_docs: int, share: float, documents: bool) -> DataFrame:
    """(key, n, common, removed) for each host and text with common lines: the lines, their words, and how many rows have that text. A text is judged once, before its copies meet the verdict."""
    # a host with a text is one key, and so is a host with a line
    texts = measured.groupBy(F.struct("host", "digest").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.first("lines").alias("lines"))
    lines = texts.select("key", "n", F.explode("lines").alias("l")).select("key", F.col("n").alias("rows"), F.struct(F.col("key.host").alias("host"), F.col("l.line").alias("line")).alias("place"), F.col("l.words").alias("words"))
    common = stored(common_lines(measured, least_docs, share, documents).select(F.struct("host", "line").alias("place"), "n"), "common")
    total = common.agg(F.sum("n")).first()[0] or 0
    found = join_hot(lines, common, "place", ["key"], total, "inner")
    return found.groupBy("key").agg(F.first("rows").alias("n"), F.collect_set("place.line").alias("common"), F.sum("words").alias("removed"))


def remaining(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", least_words: int = 20, most_repeated: int = 30, least_docs: int = 10, share: float = 0.01, most_removed: float = 0.5, documents: bool = False) -> DataFrame:
    """(doc_id, kept, removed_words, text) of every row: what judge says of it, and its text without the host's common lines.

    Verdicts belong to the pair of host and text, so rows meet theirs by it; where many rows have one text, they are dealt out. A null text stays null; blank lines stay.
    """
    measured = stored(measure(docs, id_col, text_col, host_col), "quality")
    figures = measured.groupBy(F.struct("host", "digest").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.first("n_words").alias("n_words"), F.first("n_repeat_words").alias("n_repeat_words"))
    facts = figures.join(_lost(measured, least_docs, share, documents).select("key", "common"), "key", "left")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("-")).alias("host"),
        F.col(text_col).cast("string").alias("text"),
    ).withColumn("key", F.struct("host", F.expr("xxhash64(coalesce(text, ''))").alias("digest"))).drop("host")
    # the place of a row in its partition deals out rows that are equal
    joined = join_hot(rows.withColumn("row", F.monotonically_increasing_id()), facts, "key", ["row"], measured.count(), "inner")
    lines = "zip_with(split(text, '\\n'), split(lower(regexp_replace(text, '[\\\\x20\\\\x09\\\\x0B-\\\\x0D]+', ' ')), '\\n'), (raw, p) -> struct(raw as raw, trim(p) as plain))"
    gone = f"filter({lines}, x -> array_contains(common, xxhash64(x.plain)))"
    removed = f"coalesce(aggregate({gone}, 0L, (n, x) -> n + length(x.plain) - length(replace(x.plain, ' ', '')) + 1), 0L)"
    left = f"if(common is null, text, array_join(transform(filter({lines}, x -> not array_contains(common, xxhash64(x.plain))), x -> x.raw), '\n'))"
    judged = joined.selectExpr("doc_id", "n_words", "n_repeat_words", f"{removed} as removed_words", f"{left} as text")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    return judged.select("doc_id", (~failed & (F.col("removed_words") <= most_removed * F.col("n_words"))).alias("kept"), "removed_words", "text")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", least_words: int = 20, most_repeated: int = 30, least_docs: int = 10, share: float = 0.01, most_removed: float = 0.5, documents: bool = False) -> DataFrame:
    """Every row's figures, base_failed, removed_words and kept."""
    measured = stored(measure(docs, id_col, text_col, host_col), "quality")
    lost = _lost(measured, least_docs, share, documents).select("key", "n", "removed")
    rows = measured.drop("lines").withColumn("key", F.struct("host", "digest")).withColumn("row", F.monotonically_increasing_id())
    joined = join_hot(rows, lost, "key", ["row"], measured.count())
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    gone = F.coalesce("removed", F.lit(0))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), gone.cast("long").alias("removed_words"),
        (~failed & (gone <= most_removed * F.col("n_words"))).alias("kept"),
    )
