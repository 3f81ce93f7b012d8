"""JSON files in byte ranges: every border, quotes, escapes and brackets in strings, against the parser of the standard library."""

import json
import random

import numpy as np
import pytest

from digestlake.sources import jsonsplits
from digestlake.sources import posts as source

NASTY = ['plain', 'a "quoted" one', "back\\slash", 'ends in backslash \\', '\\" both', "[{]}", '{"id": "no"}', "ünï 😀  ", "tab\tline\nfeed", '"tweets": [', "\\\\\\", ""]


def posts(n, seed=1):
    rng = random.Random(seed)
    return [{"id": str(k), "text": rng.choice(NASTY) + rng.choice(NASTY), "created_at": "Mon Jan 01 00:00:00 +0000 2024", "user": {"name": "N", "screen_name": f"u{k % 7}", "verified": k % 2 == 0, "followers": k}, "metrics": {"likes": k, "retweets": 1, "replies": 0, "views": "5"}, "is_retweet": False, "is_quote": False, "tags": [{"a": [1, {"b": "]"}]}]} for k in range(n)]


FORMS = {
    "array": lambda rows: json.dumps(rows),
    "spread": lambda rows: "﻿ " + json.dumps(rows, indent=2, ensure_ascii=False),
    "envelope": lambda rows: json.dumps({"tweets": rows, "stats": {"by": {"x": [{"id": "not one"}]}, "total": len(rows)}}),
    "late": lambda rows: json.dumps({"stats": {"list": [{"id": "not one"}], "o": {"id": "nor this"}}, "others": [{"id": "neither"}], "tweets" : rows}, indent=1),
}


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("split", [97, 1000, 1 << 20])
def test_ranges_give_the_records_of_the_whole(spark, tmp_path, form, split):
    rows = posts(60)
    for k, part in enumerate((rows[:50], rows[50:])):
        (tmp_path / f"f{k}.json").write_text(FORMS[form](part), encoding="utf-8")
    got = sorted(jsonsplits.records(spark, str(tmp_path), split).collect(), key=lambda r: (r["file"], r["at"]))
    assert [json.loads(r["value"]) for r in got] == rows


def test_every_border_of_a_small_file(tmp_path):
    """All sizes of ranges from one byte on, by the functions that tasks run."""
    rows = posts(4, seed=3)
    path = tmp_path / "f.json"
    path.write_text(json.dumps({"stats": {"s": ["{", 'x"\\']}, "tweets": rows}), encoding="utf-8")
    data = np.frombuffer(path.read_bytes(), np.uint8)
    with open(path, "rb") as raw:

        class File:
            def read_at(self, size, place):
                raw.seek(place)
                return raw.read(size)

        f = File()
        for size in [*range(1, 40), 101, len(data)]:
            case, stack, got = jsonsplits.OUTSIDE, [], []
            for begin in range(0, len(data), size):
                listed = len(stack) > 1 and stack[0][0] == "{" and stack[1][0] == "[" and jsonsplits._named(f, stack[1][1])
                got += jsonsplits._records(f, begin, min(size, len(data) - begin), len(data), case, "".join(k for k, _ in stack), listed)
                s = jsonsplits.summary(data[begin : begin + size], begin)[case]
                stack = stack[: max(0, len(stack) - s["closed"])] + list(zip(s["kinds"], s["places"]))
                case = s["end"]
            assert [json.loads(v) for _, v in got] == rows, size


def test_posts_of_a_split_file_come_from_several_tasks(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps(posts(200)), encoding="utf-8")
    whole, split = (source.read_json(spark, str(tmp_path / "f.json"), n) for n in (1 << 26, 4000))
    assert split.rdd.getNumPartitions() >= 5
    flat = lambda df: [tuple(r)[:-1] for r in source.flat(df).orderBy("_ord").collect()]
    assert flat(whole) == flat(split) and [r[0] for r in flat(whole)] == [str(k) for k in range(200)]


def test_nothing_and_broken_ends(spark, tmp_path):
    for name, text in {"empty": "", "none": "[]", "cut": json.dumps(posts(5))[:-40], "scalars": '[1, null, "x", {"id": "7"}]'}.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    got = {}
    for r in jsonsplits.records(spark, str(tmp_path), 300).collect():
        got.setdefault(r["file"].rsplit("/", 1)[-1][:-5], []).append(json.loads(r["value"])["id"])
    assert {k: sorted(v) for k, v in got.items()} == {"cut": ["0", "1", "2", "3"], "scalars": ["7"]}
