"""The page source: stop conditions, cursors, pushed filters, and streams that go on where they stopped."""

import json

import pytest
from pyspark.sql import functions as F

from digestlake.operators import posts as operators
from digestlake.sources import pages, replay
from digestlake.sources import posts as source


def page(ids, cursor=None, search=False, **more):
    entries = [{"entryId": f"tweet-{i}", "content": {"itemContent": {"tweet_results": {"result": {"__typename": "Tweet", "rest_id": str(i), "legacy": {"id_str": str(i), "full_text": f"text {i}", "favorite_count": i}}}}}} for i in ids]
    if cursor is not None:
        entries.append({"entryId": "cursor-bottom-0", "content": {"value": cursor}})
    listed = {"instructions": [{"type": "TimelineAddEntries", "entries": entries}]}
    data = {"search_by_raw_query": {"search_timeline": {"timeline": listed}}} if search else {"home": {"home_timeline_urt": listed}}
    return json.dumps({"data": data} | more)


@pytest.fixture
def feeds(spark, tmp_path):
    """Writes {feed: [(cursor, text)]} and gives the folder."""

    def write(content, folder="pages"):
        rows = [(feed, k, cursor, text) for feed, listed in content.items() for k, (cursor, text) in enumerate(listed)]
        path = f"file://{tmp_path}/{folder}"
        replay.capture(spark.createDataFrame(rows, "feed string, page long, cursor string, text string"), path)
        return path

    return write


def got(df):
    return sorted((r["feed"], r["page"], r["cursor"], r["next"]) for r in df.select("feed", "page", "cursor", "next").collect())


def test_feeds_are_followed_to_their_ends(spark, feeds):
    path = feeds({
        "chain": [(None, page([1, 2], "a")), ("a", page([3], "b")), ("b", page([4]))],
        "again": [(None, page([5], "x")), ("x", page([6], "y")), ("y", page([7], "x"))],
        "own": [(None, page([5], "z")), ("z", page([6], "z"))],
        "missing": [(None, page([8], "gone"))],
        "broken": [(None, page([9], "c")), ("c", "no json")],
        "errors": [(None, json.dumps({"errors": [1]}))],
        "warned": [(None, page([10], errors=[1]))],
        "unasked": [("q", page([11]))],
    })
    assert got(replay.read(spark, path)) == sorted([
        ("chain", 0, "", "a"), ("chain", 1, "a", "b"), ("chain", 2, "b", None), ("again", 0, "", "x"), ("again", 1, "x", "y"), ("again", 2, "y", "x"), ("own", 0, "", "z"), ("own", 1, "z", "z"),
        ("missing", 0, "", "gone"), ("broken", 0, "", "c"), ("warned", 0, "", None),
    ], key=lambda r: r[:2])


def test_a_page_without_posts_ends_a_search_and_no_timeline(spark, feeds):
    path = feeds({"t": [(None, page([1], "a")), ("a", page([], "b")), ("b", page([2]))], "s": [(None, page([1], "a", True)), ("a", page([], "b", True)), ("b", page([2], None, True))]})
    assert [x[:2] for x in got(replay.read(spark, path).where("feed = 't'"))] == [("t", 0), ("t", 1), ("t", 2)]
    assert [x[:2] for x in got(replay.read(spark, path, search=True).where("feed = 's'"))] == [("s", 0), ("s", 1)]


def test_target(spark, feeds):
    path = feeds({"f": [(None, page([1, 2, 3], "a")), ("a", page([4, 5], "b")), ("b", page([6], "c")), ("c", page([7]))]})
    for target, n in ((1, 1), (3, 1), (4, 2), (5, 2), (6, 3), (100, 4)):
        assert replay.read(spark, path, target=target).count() == n


def test_filters_spare_requests(spark, feeds):
    path = feeds({f: [(None, page([1], "a")), ("a", page([2], "b")), ("b", page([3]))] for f in ("x", "y", "z")})
    reader = replay._Reader(path, 100, False)
    from pyspark.sql.datasource import EqualTo, GreaterThan, LessThan, StringContains

    left = list(reader.pushFilters([EqualTo(("feed",), "x"), LessThan(("page",), 2), GreaterThan(("page",), 0), StringContains(("text",), "t")]))
    assert [type(f) for f in left] == [StringContains] and [p.value for p in reader.partitions()] == ["x"]
    assert [r[:2] for r in reader.read(replay.Feed("x"))] == [("x", 1)]
    df = replay.read(spark, path).where("feed in ('x', 'z') and page >= 1")
    assert [x[:2] for x in got(df)] == [("x", 1), ("x", 2), ("z", 1), ("z", 2)] and df.rdd.getNumPartitions() == 2


def test_posts_of_followed_pages(spark, feeds):
    path = feeds({"f": [(None, page([1, 2], "a")), ("a", page([3]))]})
    rows = source.flat(pages.posts(pages.entries(pages.parse(replay.read(spark, path))), "f"))
    assert sorted((r["id"], r["text"], r["likes"]) for r in rows.collect()) == [("1", "text 1", 1), ("2", "text 2", 2), ("3", "text 3", 3)]


def run(spark, path, out, checkpoint):
    query = replay.stream(spark, path).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    query.processAllAvailable()
    query.stop()


def test_a_stream_goes_on_at_its_cursor(spark, feeds, tmp_path):
    path = feeds({"f": [(None, page([1], "a")), ("a", page([2], "b"))], "g": [(None, page([5]))]})
    out, checkpoint = f"file://{tmp_path}/out", f"file://{tmp_path}/checkpoint"
    run(spark, path, out, checkpoint)
    first = got(spark.read.parquet(out))
    assert [x[:2] for x in first] == [("f", 0), ("f", 1), ("g", 0)]
    feeds({"f": [("b", page([3], "c")), ("c", page([4]))], "h": [(None, page([6]))]})
    run(spark, path, out, checkpoint)
    assert [x[:2] for x in got(spark.read.parquet(out))] == [("f", 0), ("f", 1), ("f", 2), ("f", 3), ("g", 0), ("h", 0)]


def test_offsets_give_the_same_pages_again(feeds):
    path = feeds({"f": [(None, page([1], "a")), ("a", page([2], "b")), ("b", page([3], "a"))]})
    stream = replay._Stream(path, 100, False)
    rows, one = stream.read(stream.initialOffset())
    more, two = replay._Stream(path, 100, False).read(json.loads(json.dumps(one)))
    rest, three = replay._Stream(path, 100, False).read(two)
    assert [r[1] for r in (*rows, *more, *rest)] == [0, 1, 2] and three["f"]["done"]
    assert [r[1] for r in stream.readBetweenOffsets({}, three)] == [0, 1, 2] and [r[1] for r in stream.readBetweenOffsets(one, two)] == [1]
    none, same = stream.read(three)
    assert list(none) == [] and same == three


def test_operators_of_a_search_hold_for_posts_at_hand(spark, sf):
    assert replay.predicates("bitcoin min_faves:1000 filter:links from:src3 -filter:replies") == {"least_likes": 1000, "links": True, "account": "src3", "replies": False}
    assert replay.predicates("just words") == {}
    p = source.view(spark, sf)
    some = operators.search(p, **replay.predicates("min_faves:2000 -filter:replies"))
    assert 0 < some.count() < p.count() and some.where(F.col("likes") < 2000).count() == 0


def test_pages_come_in_batches_of_bounded_size(spark, tmp_path, monkeypatch):
    """A feed of large pages: no batch holds more than its share, and all pages come."""
    rows = [("a", f"next-{i - 1}" if i else None, i, json.dumps({"data": {"home": {"home_timeline_urt": {"instructions": [{"type": "TimelineAddEntries", "entries": [{"entryId": f"cursor-bottom-{i}", "content": {"value": f"next-{i}", "x": "y" * 5000}}]}]}}}})) for i in range(40)]
    replay.capture(spark.createDataFrame(rows, "feed string, cursor string, page long, text string"), str(tmp_path / "pages"))
    monkeypatch.setattr(replay, "BATCH_CHARACTERS", 20_000)
    reader = replay._Batches(str(tmp_path / "pages"), 1 << 40, False)
    (part,) = reader.partitions()
    batches = list(reader.read(part))
    assert len(batches) > 5 and max(b.nbytes for b in batches) < 40_000
    assert [x for b in batches for x in b.column("page").to_pylist()] == list(range(40))
    assert replay.read(spark, str(tmp_path / "pages"), target=1 << 40).count() == 40
