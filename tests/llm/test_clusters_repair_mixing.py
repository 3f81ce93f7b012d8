"""Centroid clustering, conversation repair and least-squares packing against brute force."""

import collections
import hashlib
import heapq
import math
import random
import re
import zlib
from functools import cache
from itertools import product

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from digestlake.llm import centroids, conversations, mixing, queries

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# -- centroid clustering --------------------------------------------------------------------------


def brute_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centers = [x for _, x in sorted((name(i), x) for i, x in kept)[:k]]
    gap = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    assign = lambda: [min((gap(x, c), n) for n, c in enumerate(centers)) for _, x in kept]
    for _ in range(rounds):
        near = [n for _, n in assign()]
        centers = [[sum(x[d] for (_, x), m in zip(kept, near) if m == n) // near.count(n) for d in range(64)] if n in near else c for n, c in enumerate(centers)]
    found = assign()
    each = {n: sum(d for d, m in found if m == n) for _, n in found}
    return [(i, n, d, each[n], sum(each.values()), hashlib.sha256(",".join(map(str, centers[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(kept, found)]


def by_text(rows):
    return sorted(map(str, map(tuple, rows)))


VECTORS = "vec_id long, embedding array<double>, x string, norms string, cluster string, c int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "n", "c", 1) for i, v in rows], VECTORS)


def odd_vectors():
    rng = random.Random(3)
    unit = lambda: [rng.gauss(0, 0.12) for _ in range(64)]
    hot = unit()
    rows = [(i, unit()) for i in range(60)] + [(100 + i, hot) for i in range(40)] + [(7, unit()), (7, hot), (None, hot), (None, unit())]
    return rows + [(200, None), (201, []), (202, unit()[:63]), (203, [None, *unit()[1:]]), (204, [float("nan"), *unit()[1:]]), (205, [float("-inf"), *unit()[1:]])]


def test_clusters_against_brute_force(spark):
    rows = odd_vectors()
    assert by_text(centroids.judged(vectors(spark, rows)).collect()) == by_text(brute_clusters(rows))


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = odd_vectors()[:5]
    assert by_text(centroids.judged(vectors(spark, rows)).collect()) == by_text(brute_clusters(rows))
    assert centroids.judged(vectors(spark, [])).count() == 0
    assert centroids.judged(vectors(spark, [(1, None), (2, [1.0])])).count() == 0


def test_clusters_of_equal_vectors_take_the_smaller_number(spark):
    rows = [(i, [0.5] * 64) for i in range(40)]
    assert {r["cluster"] for r in centroids.judged(vectors(spark, rows)).collect()} == {0}


def test_components_beyond_the_integers_are_an_error(spark):
    with pytest.raises(PySparkException, match="too large"):
        centroids.judged(vectors(spark, [(1, [1e30] * 64)])).collect()


def test_bounds_lie_below_distances_and_prune():
    rng = np.random.default_rng(5)
    kind = rng.integers(0, 8, 4000)
    # clusters whose segments have different norms, as bounds tell them apart by those
    shape = np.repeat(rng.integers(1, 40, (8, 8)), 8, axis=1) * rng.choice([-1, 1], (8, 64))
    x = np.rint(shape[kind] + rng.normal(0, 1, (4000, 64))).astype(np.int64)
    centers = x[:16]
    number, d, taken = centroids.nearest(x, centroids.segment_norms(x, 8), centers, centroids.segment_norms(centers, 8))
    every = ((x[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
    assert (d == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()
    assert taken < 0.5 * every.size


def test_large_integers_stay_exact():
    rng = np.random.default_rng(6)
    x = rng.integers(-(1 << 27) + 1, 1 << 27, (300, 64))
    centers = np.concatenate([x[:10], x[:10]])
    number, d, _ = centroids.nearest(x, centroids.segment_norms(x, 8), centers, centroids.segment_norms(centers, 8))
    every = np.array([[sum((int(p) - int(q)) ** 2 for p, q in zip(a, c)) for c in centers] for a in x[:40]])
    assert d[:40].tolist() == every.min(axis=1).tolist() and number[:40].tolist() == every.argmin(axis=1).tolist()


# -- conversations --------------------------------------------------------------------------------


def brute_rows(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if what:
            text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(what, text)
            out += [(conv, turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    return out


LEGAL = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NAMES = (("u", "user"), ("a", "assistant"))


def searched(rows):
    """Uniform-cost search over (row, roles so far in the grammar, audit); rows are (role, text, fault), and few."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, out = heapq.heappop(heap)
        if at == len(rows) and last in ("", "a"):
            return cost, audit, out
        if (at, last, audit) in seen:
            continue
        seen.add((at, last, audit))
        for initial, role in NAMES:
            if (last, initial) in LEGAL:
                heapq.heappush(heap, (cost + 5, audit + "I", at, initial, (*out, f"{role}:")))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, last, out))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if (last, role[:1]) in LEGAL:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, role[:1], (*out, f"{role}:{text}")))
                for initial, name in NAMES:
                    if (last, initial) in LEGAL:
                        heapq.heappush(heap, (cost + 1 + more, audit + "R", at + 1, initial, (*out, f"{name}:{text}")))


def brute_repair(rows):
    """From the last row backwards: for each state of the grammar, the least (cost, audit, rows) of what is to come."""

    def with_insertions(best):
        for _ in range(3):
            for (last, initial), to in LEGAL.items():
                if initial != "s" and to in best:
                    cost, audit, out = best[to]
                    way = (cost + 5, "I" + audit, (f"{dict(NAMES)[initial]}:", *out))
                    best[last] = min(best.get(last, way), way)
        return best

    best = with_insertions({"": (0, "", ()), "a": (0, "", ())})
    for role, text, fault in reversed(rows):
        new = {}
        for last in ("", "s", "u", "a"):
            ways = [(2 + best[last][0], "D" + best[last][1], best[last][2])] if last in best else []
            more = 5 if fault == "truncated" else 0
            options = [(role[:1], role, "K", 0)] + [(i, n, "R", 1) for i, n in NAMES]
            for initial, name, letter, cost in options if fault not in ("blank", "duplicate") else []:
                if (last, initial) in LEGAL and LEGAL[last, initial] in best:
                    to = best[LEGAL[last, initial]]
                    ways.append((cost + more + to[0], letter + to[1], (f"{name}:{text}", *to[2])))
            if ways:
                new[last] = min(ways)
        best = with_insertions(new)
    return best[""]


def test_composition_against_search():
    rng = random.Random(8)
    kinds = {"blank": conversations.GONE, "duplicate": conversations.GONE, "truncated": conversations.CUT, "": conversations.FINE}
    for _ in range(150):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), f"t{k}", rng.choice(["", "", "", "blank", "truncated"])) for k in range(rng.randint(0, 5))]
        stretch = conversations.Stretch(conversations.STATES)
        for role, _, fault in rows:
            stretch.add(role[:1], kinds[fault])
        cost, audit = conversations.finish([(to, c, x) for e, to, c, x in stretch.ways() if e == conversations.NOTHING])
        assert (cost, audit) == searched(rows)[:2] == brute_repair(rows)[:2]
        assert searched(rows)[2] == brute_repair(rows)[2]


def brute_audit(rows, damage=True):
    out = []
    every = brute_rows(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in every if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = [t for _, t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, judged = set(), []
        for _, _, role, text in own:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, left = brute_repair(judged)
        faults = [f for _, _, f in judged]
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return out


TURNS = "conv_id long, turn long, role string, text string, part int, key string, n string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", "n") for r in rows], TURNS)


def random_turns(seed, convs=40, most=9):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Is it?", "it breaks", "", " \n", "Well. ", "it breaks off, ", None, "Ünïcode 😀."]
    rows = []
    for c in range(convs):
        rows += [(c, rng.choice([t, t, t, t + 1, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "s", ""]), rng.choice(texts)) for t in range(rng.randint(1, most))]
    return rows + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Hi."), (None, None, "user", "Yes."), (900, 1, None, None), (901, None, "user", "Twice."), (901, None, "user", "Twice.")]


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_against_uniform_cost_search(spark, seed):
    rows = random_turns(seed)
    assert by_text(conversations.audited(turns(spark, rows)).collect()) == by_text(brute_audit(rows))


def test_long_conversations_are_composed_from_parts(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"T{t}.", f"t{t}", "Same.", ""])) for t in range(400)] + [(2, t, "user", "Same.") for t in range(60)] + random_turns(3, convs=6)
    monkeypatch.setattr(conversations, "PART_BYTES", 600)
    joined = conversations.composed(conversations.judged_rows(conversations.damaged(turns(spark, rows)))).persist()
    assert joined.where("conv_id = 1 and nth = -1").count() > 5
    assert by_text(conversations.audited(turns(spark, rows)).collect()) == by_text(brute_audit(rows))


def test_repaired_rows_follow_the_grammar(spark):
    rows = random_turns(5)
    _, left = conversations.repair(turns(spark, rows).withColumn("n", F.lit(1).cast("long")).na.fill({"role": " ", "text": " "}))
    shown = {}
    for r in sorted(left.collect(), key=lambda r: r["place"]):
        assert r["place"] == len(shown.setdefault(r["conv_id"], []))
        shown[r["conv_id"]].append(r["role"][:1])
    assert shown and all(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in shown.values())


def test_equal_rows_in_great_number_are_counted(spark):
    rows = [(5, 3, "user", "Copy.")] * 3000 + [(5, 4, "assistant", "Answer.")]
    (r,) = conversations.audited(turns(spark, rows)).collect()
    n = sum(len(brute_rows([x])) for x in rows[:1]) * 3000
    assert r["duplicate"] == n - 1 and r["audit"].count("D") >= n - 1


def test_no_conversations(spark):
    assert conversations.audited(turns(spark, [])).count() == 0


def test_a_conversation_without_rows_after_damage(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (r,) = conversations.audited(turns(spark, [(dropped, 0, "user", "Hi.")])).collect()
    assert tuple(r) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("name", ["op11_block_norms", "op12_edit_transducer"])
def test_same_rows_as_sql(spark, sf, name):
    con = duckdb.connect()
    for table in ("embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    ours = queries.queries()[name](spark, sf)
    theirs = con.execute(queries.oracle_sql()[name]).df()
    assert by_text(ours.select(*sorted(ours.columns)).toPandas().astype(object).itertuples(index=False)) == by_text(theirs[sorted(theirs.columns)].astype(object).itertuples(index=False))


# -- packing --------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, start int, part string, class string, ids string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 1, "p", "c", "i") for i, t in rows], DOCS)


@cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def library_ids(text):
    return [*library().encode(text or "", add_special_tokens=False).ids, 1]


def held(spark, rows, capacity=64, **more):
    """The pieces, after holding them against the ids of whole texts by the library."""
    pieces = mixing.pack(documents(spark, rows), TOKENIZER, capacity, **more).collect()
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(library_ids(t))
    used = {}
    for p in pieces:
        assert any(len(x) == p["doc_tokens"] and zlib.crc32(np.array(x[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) == p["ids_crc32"] for x in ids[p["doc_id"]])
        used.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert sum(p["length"] for p in pieces) == sum(len(x) for xs in ids.values() for x in xs)
    for i, xs in ids.items():
        if len(xs) == 1:
            own = sorted((p["start"], p["length"]) for p in pieces if p["doc_id"] == i)
            assert [s for s, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) == len(xs[0])
    for s in used.values():
        s.sort()
        assert [at for at, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))] and sum(n for _, n in s) <= capacity
    return pieces


def padding(pieces, capacity):
    fill = {}
    for p in pieces:
        fill[p["sequence_id"]] = fill.get(p["sequence_id"], 0) + p["length"]
    return sum((n if n & (n - 1) == 0 else capacity) - n for n in fill.values())


def test_pieces_hold_every_id_once(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma,", "Delta!"]) for _ in range(rng.randint(0, 70)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (None, "no id at all"), (None, None), (2000, "twice twice"), (2000, "twice twice"), (3000, "word " * 5000)]
    pieces = held(spark, rows, classes=16)
    assert padding(pieces, 64) <= 0.01 * sum(p["length"] for p in pieces)
    count = collections.Counter(p["doc_id"] for p in pieces if p["doc_id"] in range(300))
    tokens = {p["doc_id"]: p["doc_tokens"] for p in pieces}
    # most documents are cut no more than their length asks for
    assert sum(n == -(-tokens[i] // 64) for i, n in count.items()) > 200


def test_one_length_and_copies(spark):
    rows = [(i, "the same words again and again") for i in range(500)]
    assert padding(held(spark, rows, classes=16), 64) == 0


def test_many_slices_are_joined_by_sort_and_merge(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(mixing, "SLICE", 4)
    held(spark, [(i, "word " * (i % 61)) for i in range(200)], classes=16)


def test_nothing_to_pack(spark):
    assert mixing.pack(documents(spark, []), TOKENIZER).count() == 0
    assert [p["length"] for p in held(spark, [(1, None)])] == [1]


def test_combinations_are_all_that_fill_a_sequence():
    brute = {tuple(sorted(m, reverse=True)) for n in range(1, 5) for m in product(range(1, 13), repeat=n) if sum(m) == 12}
    assert set(mixing.combinations(12, 4)) == brute and len(mixing.combinations(12, 4)) == len(brute)


def test_least_squares_meet_their_conditions():
    rng = np.random.default_rng(2)
    for rows, columns in ((12, 40), (30, 10), (64, 300)):
        a, b = rng.integers(0, 3, (rows, columns)).astype(float), rng.normal(3, 4, rows)
        x = mixing.nnls(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and slope.max() < 1e-6 * np.abs(a.T @ b).max() and np.abs(slope[x > 0]).max(initial=0) < 1e-6 * np.abs(a.T @ b).max()


def test_mixture_uses_no_document_twice():
    rng = np.random.default_rng(3)
    counts = np.concatenate([[0], rng.integers(0, 200, 64)]).astype(float)
    tokens = counts * (np.arange(65) * 32 - 16)
    found = mixing.mixture(counts, tokens, 2048, 4)
    used = np.zeros(65)
    for m, n in found:
        assert sum(m) == 64 and n > 0
        for c in m:
            used[c] += n
    assert (used <= counts).all() and used.sum() > 0.5 * counts.sum()
