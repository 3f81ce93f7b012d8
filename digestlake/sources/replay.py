"""Feeds of pages that are followed from cursor to cursor, as a Spark data source, in batch and as a stream.

    replay.register(spark)
    spark.read.format("pages").option("path", folder).load()

A folder holds captured pages as Parquet files (feed, cursor, text): what a feed answered when it was asked with a cursor, the empty one for its first page. A feed is one chain of
requests and so one partition; filters on feed and page are pushed down and spare the requests. A feed is followed until its target of posts is reached, a page has no further cursor or, in a search,
no post, a cursor comes back that has been asked before, or a page is missing, no JSON, or an answer with errors alone. The rows are pages; pages.parse and pages.posts flatten them in the JVM.

As a stream each batch asks one page of every feed that is not at its end. The offset holds, for each feed, the cursor to ask next, the page's number, the posts so far and a digest of each cursor asked, so a query that is started again
goes on where it was; a feed whose next page is not there yet is asked again with the next batch.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, SimpleDataSourceStreamReader

SCHEMA = "feed string, page long, cursor string, next string, text string"
#: What a feed is asked for unless the option target says otherwise.
TARGET = 5000
#: Characters of pages in a batch.
BATCH_CHARACTERS = 1 << 22


class Store:
    """Captured pages of one feed: the cursors are read at once, a page's text when it is asked for."""

    def __init__(self, folder: str, feed: str | None = None):
        import pyarrow.dataset as ds
        from pyarrow.fs import FileSystem

        fs, path = FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        self.data = ds.dataset(path, filesystem=fs, format="parquet")
        self.feed, self.places, self.held = feed, None, (None, None)

    def feeds(self) -> list[str]:
        out: set[str] = set()
        for batch in self.data.to_batches(columns=["feed"]):
            out |= set(batch.column(0).unique().to_pylist())
        return sorted(out)

    def fetch(self, cursor: str) -> str | None:
        """The text of the page that the feed answers a cursor with."""
        if self.places is None:
            self.places = {}
            for k, part in enumerate(f for fragment in self.data.get_fragments() for f in fragment.split_by_row_group()):
                rows = part.to_table(columns=["feed", "cursor"])
                for i, (feed, at) in enumerate(zip(rows["feed"].to_pylist(), rows["cursor"].to_pylist())):
                    if feed == self.feed:
                        self.places.setdefault(at or "", (part, k, i))
        if cursor not in self.places:
            return None
        part, k, i = self.places[cursor]
        if self.held[0] != k:
            self.held = k, part.to_table(columns=["text"])["text"]
        return self.held[1][i].as_py()


def look(text: str | None) -> tuple[int, str | None] | None:
    """(posts, next cursor) of a page, or None if it is no answer."""
    try:
        page = json.loads(text) if text is not None else None
    except ValueError:
        return None
    if not isinstance(page, dict) or (page.get("errors") and not page.get("data")):
        return None
    data = page.get("data") or {}
    home = (data.get("home") or {}).get("home_timeline_urt")
    found = home or ((data.get("search_by_raw_query") or {}).get("search_timeline") or {}).get("timeline") or {}
    posts, cursor = 0, None
    for part in found.get("instructions") or []:
        listed = {"TimelineAddEntries": part.get("entries"), "TimelineAddToModule": part.get("moduleItems") if home is None else None}.get(part.get("type")) or []
        for entry in listed:
            name, content = entry.get("entryId") or "", entry.get("content") or entry.get("item") or {}
            if "cursor-bottom" in name:
                cursor = content.get("value")
            elif name.startswith("tweet-"):
                result = ((content.get("itemContent") or {}).get("tweet_results") or {}).get("result") or {}
                posts += bool((result.get("tweet") or {} if result.get("__typename") == "TweetWithVisibilityResults" else result).get("legacy"))
    return posts, cursor


def _digest(cursor: str) -> str:
    return hashlib.sha256(cursor.encode()).hexdigest()[:16]


def begun() -> dict:
    return {"cursor": "", "page": 0, "posts": 0, "asked": [], "done": False}


def step(store: Store, state: dict, target: int, search: bool, known: set[str] | None = None) -> tuple[tuple | None, dict]:
    """The next page of a feed as (page, cursor, next, text), or None, and the state after it. Cursors asked are kept in the state, or in known where a run is not to be taken up again."""
    if state["done"] or state["posts"] >= target:
        return None, state | {"done": True}
    text = store.fetch(state["cursor"])
    seen = look(text)
    if seen is None:
        return None, state | {"done": text is not None}
    posts, cursor = seen
    if known is None:
        asked = [*state["asked"], _digest(state["cursor"])]
    else:
        known.add(_digest(state["cursor"]))
        asked = known
    more = bool(cursor) and _digest(cursor) not in asked and not (search and posts == 0)
    return (state["page"], state["cursor"], cursor, text), {"cursor": cursor if more else state["cursor"], "page": state["page"] + 1, "posts": state["posts"] + posts, "asked": asked if known is None else [], "done": not more}


class Pages(DataSource):
    """Options: path, target (posts of a feed), search (whether a page without posts ends a feed)."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return SCHEMA

    def _settings(self) -> tuple[str, int, bool]:
        if "path" not in self.options:
            raise ValueError("pages are read from a path")
        return self.options["path"], int(self.options.get("target", TARGET)), self.options.get("search", "false").lower() == "true"

    def reader(self, schema) -> DataSourceReader:
        return _Batches(*self._settings())

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Stream(*self._settings())


class Feed(InputPartition):
    pass


class _Reader(DataSourceReader):
    def __init__(self, path: str, target: int, search: bool):
        self.path, self.target, self.search = path, target, search
        self.only: set[str] | None = None
        self.first, self.last = 0, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Feeds by name and pages by number are told here; all other filters are left to Spark."""
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("feed",) and isinstance(f, (EqualTo, In)):
                names = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only = names if self.only is None else self.only & names
            elif column == ("page",) and isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                last = f.value - isinstance(f, LessThan)
                self.last = last if self.last is None else min(self.last, last)
                if isinstance(f, EqualTo):
                    self.first = max(self.first, f.value)
            elif column == ("page",) and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.first = max(self.first, f.value + isinstance(f, GreaterThan))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [Feed(x) for x in Store(self.path).feeds() if self.only is None or x in self.only]

    def read(self, partition: InputPartition) -> Iterator:
        store, state, known = Store(self.path, partition.value), begun(), set()
        while not state["done"] and (self.last is None or state["page"] <= self.last):
            row, state = step(store, state, self.target, self.search, known)
            if row is None:
                return
            if row[0] >= self.first:
                yield (partition.value, *row)


class _Batches(_Reader):
    """The same pages as Arrow batches of BATCH_CHARACTERS: rows would be held until there are as many as a batch takes, whatever their size."""

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa

        rows, size = [], 0
        names = [c.split()[0] for c in SCHEMA.split(", ")]

        def out() -> pa.RecordBatch:
            columns = [pa.array(x, pa.int64() if name == "page" else pa.string()) for name, x in zip(names, zip(*rows))]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for row in super().read(partition):
            rows.append(row)
            size += len(row[4])
            if size >= BATCH_CHARACTERS:
                yield out()
                size = 0
        if rows:
            yield out()


class _Stream(SimpleDataSourceStreamReader):
    def __init__(self, path: str, target: int, search: bool):
        self.path, self.target, self.search = path, target, search

    def initialOffset(self) -> dict:
        return {}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        """One page of every feed that goes on."""
        rows, after = [], dict(start)
        for feed in Store(self.path).feeds():
            row, after[feed] = step(Store(self.path, feed), start.get(feed) or begun(), self.target, self.search)
            if row is not None:
                rows.append((feed, *row))
        return iter(rows), after

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """What lies between two offsets, once more."""
        for feed in sorted(end):
            store, state = Store(self.path, feed), start.get(feed) or begun()
            while state["page"] < end[feed]["page"]:
                row, state = step(store, state, self.target, self.search)
                if row is None:
                    break
                yield (feed, *row)

    def commit(self, end: dict) -> None:
        pass


def register(spark: SparkSession) -> None:
    """Makes the source known, and lets filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Pages)


def read(spark: SparkSession, path: str, target: int = TARGET, search: bool = False) -> DataFrame:
    register(spark)
    return spark.read.format("pages").option("path", path).option("target", target).option("search", str(search)).load()


def stream(spark: SparkSession, path: str, target: int = TARGET, search: bool = False) -> DataFrame:
    register(spark)
    return spark.readStream.format("pages").option("path", path).option("target", target).option("search", str(search)).load()


def capture(pages: DataFrame, path: str) -> None:
    """Writes pages (feed, cursor, text), those of a feed in one file and in order, in row groups of a few pages."""
    pages.select("feed", F.coalesce("cursor", F.lit("")).alias("cursor"), "text", "page").repartition("feed").sortWithinPartitions("feed", "page").drop("page").write.option("parquet.block.size", 4 << 20).mode("append").parquet(path)


#: What a search says beside its words, and the argument of posts.search that does the same to posts that are at hand.
OPERATORS = {r"\bmin_faves:(\d+)": ("least_likes", int), r"\bfilter:(links)\b": ("links", bool), r"\bfrom:(\w+)": ("account", str), r"-filter:(replies)\b": ("replies", lambda _: False)}


def predicates(query: str) -> dict:
    """The arguments of posts.search that a query's operators stand for."""
    return {name: kind(m[1]) for pattern, (name, kind) in OPERATORS.items() if (m := re.search(pattern, query))}
