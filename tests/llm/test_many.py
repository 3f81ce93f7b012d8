"""Many rows, many spans, long texts: what must not grow with the square, and what must not be left out."""

import collections
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from digestlake.llm import packing, pii, quality, tokens, toxicity

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
OTHER = public_tokenizers.path("byte_bpe_50k.json")


def test_equal_rows_are_dealt_over_groups(spark):
    rows = spark.createDataFrame([(7, 0, 0, 30, 1)] * 50_000, packing.PIECES).withColumn("row", F.monotonically_increasing_id())
    sizes = collections.Counter(r["pack_group"] for r in packing._packed(rows, 4, 64, 1).select("pack_group").collect())
    assert len(sizes) == 4 and max(sizes.values()) < 14_000


def test_equal_rows_are_packed_once_each(spark):
    docs = spark.createDataFrame([(None, "the same words")] * 300 + [(5, "the same words")] * 300, "doc_id long, text string")
    got = packing.pack(docs, TOKENIZER, 16).collect()
    assert len(got) == 600 and len({(r["sequence_id"], r["offset"]) for r in got}) == 600


def labelled(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return docs, spark.createDataFrame([(i, 1, i % 2) for i in texts], "doc_id long, quality int, toxic int")


def test_a_long_text_leaves_the_sample_to_others(spark):
    """Whichever text is long, all others are learned from."""
    texts = {i: ("vile awful " if i % 2 else "kind gentle ") * 20 + f"w{i}" for i in range(120)}
    ids = sorted(i for i in texts if toxicity_trains(spark, i))
    for long in ids[:2]:
        docs, labels = labelled(spark, texts | {long: "vile awful kind gentle " * 60_000})
        network, share = toxicity.fit(docs, labels, max_bytes=1 << 20)
        assert network is not None and 0.4 < share < 0.6
        score = dict(map(tuple, toxicity.score(docs.where(F.col("doc_id") != long), network, share).collect()))
        assert np.mean([(score[i] >= 0.5) == (i % 2 == 1) for i in score]) > 0.9


def toxicity_trains(spark, i):
    return spark.range(1).select(F.lit(i).alias("doc_id")).select(toxicity.in_training()).first()[0]


def spans_in(n):
    return " and ".join(f"user{k}@mail{k % 7}.example.com or {k % 250}.{k % 200}.7.9 at +1 ({200 + k % 700}) {200 + k % 700}-{1000 + k % 9000}" for k in range(n))


def test_many_spans_in_one_text_take_linear_time(spark):
    """20 000 base spans, with their candidates, in one text; four times the spans may take six times as long at most."""
    took = {}
    for n in (1700, 6800):
        docs = spark.createDataFrame([(1, spans_in(n)), (2, "call 555 0100 now")], "doc_id long, text string")
        began = time.perf_counter()
        (one, _) = pii.find(docs).orderBy("doc_id").collect()
        took[n] = time.perf_counter() - began
        assert [len(one[k]) for k in ("email", "ip", "phone")] == [n, n, n]
    assert took[6800] < 6 * took[1700] + 5


def test_candidates_are_read_where_they_stand(spark):
    text = "é😀 " * 3000 + " a@b.co " + "x" * 4093 + " 1.2.3.4 " + "ü" * 9000 + " c@d.org"
    _, cands = pii.candidates(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    got = cands.collect()
    assert got and all(r["body"] == text[r["start"] : r["end"]] and r["lead"] == text[max(0, r["start"] - 24) : r["start"]] and r["next"] == text[r["end"] : r["end"] + 1] for r in got)


def brute_facts(row, cands):
    for c in cands:
        kinds = base = 0
        free = True
        for i, kind in enumerate(pii.KINDS):
            for b in row[kind]:
                common = min(b["end"], c["end"]) - max(b["start"], c["start"])
                free &= common <= 0
                kinds |= (1 << i) if common > 0 and 4 * common >= 3 * (b["end"] - b["start"]) else 0
                base |= (1 << i) if (b["start"], b["end"]) == (c["start"], c["end"]) else 0
        assert (c["kinds"], c["base"], c["free"]) == (kinds, base, free)


def test_candidates_meet_base_spans(spark):
    docs = spark.createDataFrame([(1, spans_in(40)), (2, "+1 (578) 555-6437 1.2.3.4.5.6 4111 1111 1111 1111 a@b.c " + "9" * 300), (None, "4111-1111-1111-1111"), (3, "")], "doc_id long, text string")
    found, cands = pii.candidates(docs)
    by_row = collections.defaultdict(list)
    for c in cands.collect():
        by_row[c["row"]].append(c)
    for row in found.collect():
        brute_facts(row, by_row[row["row"]])
    assert sum(map(len, by_row.values())) > 100


def test_copies_meet_their_verdict_by_text(spark):
    """Many copies of a page, rows without an id, lines that most texts of a host share."""
    shared = "this line is on every page of the host"
    own = lambda i: " ".join(f"word{i}x{k}" for k in range(30))
    rows = [(i, f"{own(i)}\n{shared}", "h") for i in range(40)] + [(100 + i, f"{own(0)}\n{shared}", "h") for i in range(2000)] + [(None, f"{shared}\n{shared}\n{own(5)} {own(50)}", "h"), (None, None, "h"), (7, f"{own(7)}\n{shared}", "h"), (300, shared, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = collections.Counter((r["doc_id"], r["removed_words"], r["kept"]) for r in quality.judge(docs).collect())
    want = collections.Counter((i, 0 if t is None or s is None else 9 * t.count(shared), t is not None and s is not None) for i, t, s in rows)
    assert got == want
    left = quality.remaining(docs).collect()
    assert len(left) == len(rows) and all(shared not in (r["text"] or "") for r in left if r["doc_id"] != 300)
    assert collections.Counter((r["doc_id"], r["removed_words"], r["kept"]) for r in left) == want


def test_equal_ids_are_dealt_over_files(spark, monkeypatch):
    monkeypatch.setattr(tokens, "FILE_BYTES", 20_000)
    docs = spark.createDataFrame([(None, "the same words again and again")] * 4000 + [(i, f"words {i}") for i in range(500)], "doc_id long, text string")
    files = tokens.write_files(docs, TOKENIZER)
    sizes = [r["n_docs"] for r in files.collect()]
    assert len(sizes) >= 5 and max(sizes) < 2500 and sum(sizes) == 4500
    got = tokens.read_files(files).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None] * 4000 + list(range(500))


@pytest.mark.parametrize("path", [TOKENIZER, OTHER])
def test_any_tokenizer_gives_the_ids_of_the_library(path):
    from tokenizers import Tokenizer

    texts = ["Hello  World, it's\n\n12 o'clock!", "", " leading", "trailing \t", "ÜBER Straße 😀<|endoftext|>", "the " * 50]
    ids, lengths = tokens.Encoder(path, 1).encode(texts)
    want = [[*e.ids, 1] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == want


def test_covered_bytes_hold_no_second_count():
    import tracemalloc

    import numpy as np

    from digestlake.llm import substrings

    rng = np.random.default_rng(2)
    for n in (0, 3, substrings.LENGTH, 500):
        starts = np.concatenate([rng.random(n) < 0.02, [False]])
        assert substrings.covered_by(starts).tolist() == [starts[max(0, i - substrings.LENGTH + 1) : i + 1].any() for i in range(n)]
    starts = np.zeros((1 << 22) + 1, bool)
    tracemalloc.start()
    substrings.covered_by(starts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 7 * len(starts)
