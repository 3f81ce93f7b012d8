"""Delivery once for each destination and key, and runs that go on after the last whole step."""

import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from digestlake.plans.pipeline import Pipeline
from digestlake.sources import delivery


def record(destination, address, key, payload):
    """A sender: appends what it gets to a file of its own for each process, and fails while a file says so."""
    down = os.path.join(address, f"{destination}.down")
    if os.path.exists(down):
        if "raise" in open(down).read():
            raise OSError("no connection")
        return False
    with open(os.path.join(address, f"{os.getpid()}.log"), "a") as f:
        f.write(json.dumps([destination, key, payload]) + "\n")
    return True


def sent(folder):
    return sorted(tuple(json.loads(line)[:2]) for name in os.listdir(folder) if name.endswith(".log") for line in open(os.path.join(folder, name)))


@pytest.fixture
def digests(spark, tmp_path):
    os.makedirs(tmp_path / "box")
    rows = spark.createDataFrame([(f"d{k}", f"text {k} [a](https://x.example) ") for k in range(5)], "key string, text string")
    return delivery.addressed(rows.repartition(3), {n: str(tmp_path / "box") for n in ("slack", "discord", "webhook", "file")}, "Digest")


@pytest.mark.parametrize("how", ["refuses", "raise"])
def test_a_failing_destination_is_tried_again_and_no_other_sent_twice(digests, tmp_path, how):
    box, ledger, every = tmp_path / "box", str(tmp_path / "ledger"), sorted((n, f"d{k}") for n in ("slack", "discord", "webhook", "file") for k in range(5))
    (box / "discord.down").write_text(how)
    for _ in range(2):
        with pytest.raises(PySparkException, match="not taken"):
            delivery.send(digests, "tests.test_delivery:record", ledger)
        assert sent(box) == [x for x in every if x[0] != "discord"] and not os.path.exists(f"{ledger}/_commit")
    os.remove(box / "discord.down")
    delivery.send(digests, "tests.test_delivery:record", ledger)
    assert sent(box) == every
    told = json.load(open(f"{ledger}/_commit"))
    assert [tuple(x) for x in told["sent"]] == [x for x in every if x[0] == "discord"] and len(told["before"]) == 15
    delivery.send(digests.unionByName(digests), "tests.test_delivery:record", ledger)
    assert sent(box) == every


def test_payloads_are_those_of_the_services(digests):
    got = {(r["destination"], r["key"]): r["payload"] for r in digests.collect()}
    assert got["file", "d1"] == "text 1 [a](https://x.example) "
    assert json.loads(got["slack", "d1"])["blocks"][1]["text"]["text"] == "text 1 <https://x.example|a> "
    assert json.loads(got["discord", "d1"])["embeds"][0]["title"] == json.loads(got["webhook", "d1"])["title"] == "Digest"


def counted(calls, name, change, fail=None):
    def step(rows):
        calls.append(name)
        if fail and fail():
            raise RuntimeError("killed")
        return change(rows)

    return name, step


def test_a_run_goes_on_after_the_last_whole_step(spark, tmp_path):
    calls, broken = [], [True]
    steps = [counted(calls, "double", lambda d: d.withColumn("x", F.col("x") * 2)), counted(calls, "some", lambda d: d.where("x % 4 = 0")), counted(calls, "sum", lambda d: d.agg(F.sum("x").alias("x")), lambda: broken[0])]
    rows, folder = spark.range(20).withColumnRenamed("id", "x"), f"file://{tmp_path}"
    with pytest.raises(RuntimeError, match="killed"):
        Pipeline(*steps).resumed(rows, folder, "run-1", "v1")
    # a table of a step that was not finished has no manifest and does not count
    spark.range(3).write.parquet(f"{folder}/run-1/02-sum/table")
    broken[0] = False
    again = Pipeline(*steps).resumed(rows, folder, "run-1", "v1")
    assert calls == ["double", "some", "sum", "sum"] and [tuple(r) for r in again.collect()] == [(180,)]
    assert Pipeline(*steps).resumed(rows, folder, "run-1", "v1").collect() == again.collect() and len(calls) == 4
    # another input, and a run of its own, start from the beginning
    other = Pipeline(*steps).resumed(spark.range(40).withColumnRenamed("id", "x"), folder, "run-1", "v2")
    assert [tuple(r) for r in other.collect()] == [(760,)] and calls[4:] == ["double", "some", "sum"]
    Pipeline(*steps).resumed(rows, folder, "run-2", "v1")
    assert calls[7:] == ["double", "some", "sum"]


def test_an_optional_step_may_fail_and_is_tried_again(spark, tmp_path):
    calls, broken = [], [True]
    bad = counted(calls, "extra", lambda d: d.where("x > 5"), lambda: broken[0])
    steps = [counted(calls, "double", lambda d: d.withColumn("x", F.col("x") * 2)), bad, counted(calls, "count", lambda d: d.groupBy().count())]
    rows, folder = spark.range(10).withColumnRenamed("id", "x"), f"file://{tmp_path}"
    first = Pipeline(*steps, optional=("extra",))
    assert first.resumed(rows, folder, "r").first()[0] == 10 and first.skipped == ["extra"]
    broken[0] = False
    second = Pipeline(*steps, optional=("extra",))
    assert second.resumed(rows, folder, "r").first()[0] == 7 and second.skipped == [] and calls == ["double", "extra", "count", "extra", "count"]
