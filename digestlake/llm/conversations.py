"""Repair of the structure of conversations, by weighted finite-state composition.

Three machines are composed. The input acceptor spells the rows of a conversation in order. The edit transducer keeps a row (cost 0), gives it another role
(1), deletes it (2) or inserts an empty row (5); a row that stays though it breaks off costs 5 more, and blank and repeated rows can only be deleted.
The grammar acceptor takes the roles that are left, `(s?(ua)+)?`. The composition is expanded lazily: for a kind of row, the arcs out of a state of the grammar
are made when first met. Insertions stand before the row that follows them, two at most, so states are passed in the order of rows and there is no cycle: a third insertion would come back to a state
that has been there, for a cost.

Weights are pairs (cost, string of edits' initials) in lexicographic order, added by the smaller one and multiplied by the sum and the concatenation.
Every string of a stretch of rows ends with the edit of its last row, and holds as many such edits as there are rows, so none is the beginning of another: the order
of two strings stays whatever goes before or follows, which makes the product distributive, and stretches can be composed apart. Insertions after the last row are added last.

Rows are sorted over all tasks by conversation and place, so a long conversation is spread over several. A task runs through its sorted rows once and keeps, for each state where a
stretch may begin, the best way to each state where it may end, as one byte a row. Conversations that lie within a task are finished there; of those
that reach into other tasks, two a task at most, the stretches are composed afterwards. Equal rows of a conversation are counted before they are sorted.

Defined results: a null role or text is one space; a null turn comes first; rows of one turn are ordered by role and text; a null conversation id is a conversation of its own; a role
without a first letter cannot be kept; repeated rows are rows, of which all but one are duplicates; an empty table gives no rows; columns of other names are ignored.
The string of edits of a conversation is one value, as is asked for, and its hash is taken by one task that reads the repaired rows in order and keeps none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_schema, join_hot, stored

#: The grammar acceptor: what has been read ends with nothing, a system row, a user row, an assistant row.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
GRAMMAR = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
STATES = (NOTHING, SYSTEM, USER, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, BROKEN = 0, 1, 2, 5, 5
#: What a row can hold before it is edited: nothing worth keeping, a text that breaks off, or neither.
GONE, CUT, FINE = range(3)
LABELS = [i + e for i in ("", "I", "II") for e in "DKR"]
BLANK_SPACE = r"\x20\x09-\x0D"
PART_BYTES = 32 << 20


def _moves(state: int, initial: str, kind: int) -> Iterator[tuple[int, str, int]]:
    """The edit transducer on one row, against the grammar: (cost, letter, next state)."""
    yield DELETE, "D", state
    if kind != GONE:
        more = BROKEN if kind == CUT else 0
        if (state, initial) in GRAMMAR:
            yield KEEP + more, "K", GRAMMAR[state, initial]
        for role in ROLES:
            if (state, role) in GRAMMAR:
                yield REROLE + more, "R", GRAMMAR[state, role]


def _inserted(state: int) -> list[tuple[int, str, int]]:
    """(cost, letters, next state) of no, one and two insertions; the grammar leaves one role to insert in every state."""
    out = [(0, "", state)]
    for _ in range(2):
        cost, letters, at = out[-1]
        out.append((cost + INSERT, letters + "I", next(GRAMMAR[at, role] for role in ROLES if (at, role) in GRAMMAR)))
    return out


@cache
def arcs(initial: str, kind: int) -> list[list[tuple[int, int, int]]]:
    """For each state, the least arc (cost, number of its label, next state) to each other state over one row of that kind, with the insertions before it."""
    out = []
    for state in STATES:
        best: dict[int, tuple[int, str]] = {}
        for spent, letters, at in _inserted(state):
            for cost, letter, to in _moves(at, initial, kind):
                weight = (spent + cost, letters + letter)
                best[to] = min(best.get(to, weight), weight)
        out.append([(cost, LABELS.index(label), to) for to, (cost, label) in best.items()])
    return out


class Stretch:
    """The composition over consecutive rows: for each state at its beginning, the least weight to each state at its end.

    Strings are not held: ways are ordered by their rank among those of the row before and their last label, and each row leaves a byte for each pair of states.
    """

    def __init__(self, entries: tuple[int, ...]):
        self.entries = entries
        self.cost = {e: {e: 0} for e in entries}
        self.rank = {e: {e: 0} for e in entries}
        self.back = {e: bytearray() for e in entries}
        self.rows = 0

    def add(self, initial: str, kind: int, times: int = 1) -> None:
        step = arcs(initial, kind)
        for _ in range(times):
            self.rows += 1
            for e in self.entries:
                cost, rank = self.cost[e], self.rank[e]
                best: dict[int, tuple[int, int, int, int]] = {}
                for state, spent in cost.items():
                    for more, label, to in step[state]:
                        weight = (spent + more, rank[state], LABEL_ORDER[label], state * len(LABELS) + label)
                        if to not in best or weight < best[to]:
                            best[to] = weight
                self.cost[e] = {to: w[0] for to, w in best.items()}
                self.rank[e] = {to: r for r, to in enumerate(sorted(best, key=lambda to: best[to][1:3]))}
                self.back[e] += bytes(best[s][3] if s in best else 255 for s in STATES)

    def edits(self, entry: int, state: int) -> str:
        out, back = [], self.back[entry]
        for row in range(self.rows - 1, -1, -1):
            before, label = divmod(back[4 * row + state], len(LABELS))
            out.append(LABELS[label])
            state = before
        return "".join(reversed(out))

    def ways(self) -> list[tuple[int, int, int, str]]:
        return [(e, to, cost, self.edits(e, to)) for e in self.entries for to, cost in self.cost[e].items()]


#: Labels by their letters. Ways of equal rank come from one state, and no label is the beginning of another.
LABEL_ORDER = [sorted(LABELS).index(label) for label in LABELS]


def finish(ways: list[tuple[int, int, str]]) -> tuple[int, str]:
    """The least (cost, edits) of ways (state, cost, edits), with the insertions that the grammar asks for after the last row."""
    ends = {NOTHING: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
    return min((cost + INSERT * len(ends[state]), edits + ends[state]) for state, cost, edits in ways)


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n) of rows after the damage that a checksum of conversation and turn chooses; n says how often a row stands there."""
    given = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(given("conv_id"), F.lit(":"), given("turn")).cast("binary")) % 20
    kept = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), given("role").alias("role"), given("text").alias("text"), what.alias("what")).where("what <> 0")
    text = F.when(F.col("what") == 1, F.lit("")).when(F.col("what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("what") == 4, F.lit("user")).otherwise(F.col("role"))
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("what") == 3, 2).otherwise(1).cast("long").alias("n"))


def judged_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with n, how often they occur, and what is wrong with the first of them: blank, seen before at an earlier turn, broken off. Stored."""
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    framed = lambda c: F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c))
    key = F.sha2(F.concat(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-")), F.lit("|"), framed("role"), framed("text")), 256)
    blank = ~F.col("text").rlike(f"[^{BLANK_SPACE}]")
    cut = ~F.col("text").rlike(rf"[.!?][{BLANK_SPACE}]*\z")
    # a null turn comes before all others
    place = F.struct(F.col("turn").isNotNull().alias("later"), F.col("turn").alias("turn"))
    kept = stored(counted.select("*", key.alias("key"), blank.alias("blank"), cut.alias("cut")), "turns")
    facts = kept.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least"))
    several = facts.where("n > 1")
    joined = join_hot(kept.withColumnRenamed("n", "times"), several, "key", ["turn"], kept.count())
    seen = F.coalesce(F.struct(F.col("turn").isNotNull().alias("later"), F.col("turn").alias("turn")) > F.col("least"), F.lit(False))
    return stored(joined.select("conv_id", "turn", "role", "text", F.col("times").alias("n"), "blank", seen.alias("seen"), "cut"), "judged")


FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _sorted_type(conv_type: str) -> str:
    return f"conv_id {conv_type}, part int, nth long, role string, text string, n long, whole boolean, chosen string, {FACTS}, ways array<struct<entry: int, state: int, cost: long, edits: string>>, initials array<string>, turns array<long>, distinct long"


class _Segment:
    """A stretch of one conversation with what is counted on the way."""

    def __init__(self, conv_id, entries: tuple[int, ...]):
        self.conv_id, self.stretch = conv_id, Stretch(entries)
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first = self.last = self.turn_first = self.turn_last = None

    def add(self, row: dict) -> None:
        initial, n = row["role"][:1], row["n"]
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.illegal += n - 1  # no role follows itself
        if self.first is None:
            self.first = initial
        self.last = initial
        if row["turn"] is not None and row["turn"] != self.turn_last:
            self.distinct += 1
            self.turn_last = row["turn"]
            if self.turn_first is None:
                self.turn_first = row["turn"]
        if row["blank"]:
            self.blank += n
            self.stretch.add(initial, GONE, n)
            return
        gone = n if row["seen"] else n - 1
        self.duplicate += gone
        if not row["seen"]:
            self.truncated += row["cut"]
            self.stretch.add(initial, CUT if row["cut"] else FINE)
        self.stretch.add(initial, GONE, gone)


def _counts(s: _Segment) -> dict:
    gaps = s.turn_last - s.turn_first + 1 - s.distinct if s.turn_first is not None else 0
    return {"gaps": gaps, "blank": s.blank, "duplicate": s.duplicate, "truncated": s.truncated, "illegal": s.illegal}


def composed(rows: DataFrame) -> DataFrame:
    """The judged rows in order, under (part, nth), and beside them a row for each stretch of a conversation in a part (nth = -1): finished where the conversation lies within the part (whole), with all its ways otherwise. Stored."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text") + F.octet_length("role") + 64)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES + 1)
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    # borders are drawn by the beginnings of texts, which a sample of them brings to the driver
    ranged = rows.repartitionByRange(parts, *order[:3], F.asc(F.substring("text", 1, 64))).sortWithinPartitions(*order)
    conv_type = dict(rows.dtypes)["conv_id"]
    schema = _sorted_type(conv_type)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, now, out, first = TaskContext.get().partitionId(), 0, None, [], True

        def ended(segment: _Segment, whole: bool) -> dict:
            counts = _counts(segment)
            row = {"conv_id": segment.conv_id, "part": part, "nth": -1, "whole": whole} | counts
            if whole:
                cost, edits = finish([(to, cost, segment.stretch.edits(NOTHING, to)) for to, cost in segment.stretch.cost[NOTHING].items()])
                return row | {"cost": cost, "audit": edits, "chosen": edits}
            ways = [{"entry": e, "state": to, "cost": c, "edits": x} for e, to, c, x in segment.stretch.ways()]
            return row | {"ways": ways, "initials": [segment.first, segment.last], "turns": [segment.turn_first, segment.turn_last], "distinct": segment.distinct}

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != now.conv_id:
                    if now is not None:
                        # the first conversation of a part may have begun in the part before
                        out.append(ended(now, not first))
                        first = False
                    now = _Segment(row["conv_id"], STATES if first else (NOTHING,))
                now.add(row)
                out.append({"conv_id": row["conv_id"], "part": part, "nth": nth, "role": row["role"], "text": row["text"], "n": row["n"]})
                nth += 1
            yield from _batches(out, arrow)
            out = []
        if now is not None:
            # the last one may go on in the next part
            out.append(ended(now, False))
            yield from _batches(out, arrow)

    arrow = arrow_schema(schema)
    return stored(ranged.mapInArrow(compose, schema), "stretches")


def _batches(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def _resolved(open_: DataFrame, schema: str) -> DataFrame:
    """For each stretch of a conversation that reaches over parts, the state it begins in, its edits and the place of its first row; the last one has the facts."""
    names = open_.columns

    def resolve(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        best: dict[int, tuple[int, tuple[str, ...], tuple[int, ...]]] = {NOTHING: (0, (), ())}
        for row in rows:
            new: dict[int, tuple] = {}
            for w in row["ways"]:
                if w["entry"] in best:
                    cost, edits, entries = best[w["entry"]]
                    way = (cost + w["cost"], (*edits, w["edits"]), (*entries, w["entry"]))
                    if w["state"] not in new or (way[0], way[1]) < new[w["state"]][:2]:
                        new[w["state"]] = way
            best = new
        cost, audit = finish([(state, cost, "".join(edits)) for state, (cost, edits, _) in best.items()])
        _, edits, entries = min((w for s, w in best.items() if finish([(s, w[0], "".join(w[1]))]) == (cost, audit)), key=lambda w: w[1])
        total = {k: sum(r[k] for r in rows) for k in ("blank", "duplicate", "truncated", "illegal", "distinct")}
        last, turn = None, None
        for row in rows:
            if last is not None and last + row["initials"][0] not in ("su", "ua", "au"):
                total["illegal"] += 1
            last = row["initials"][1]
            if row["turns"][0] is not None:
                total["distinct"] -= turn is not None and turn == row["turns"][0]
                turn = row["turns"][1]
        turns = [t for r in rows for t in r["turns"] if t is not None]
        facts = {k: total[k] for k in ("blank", "duplicate", "truncated", "illegal")} | {"gaps": max(turns) - min(turns) + 1 - total["distinct"] if turns else 0, "cost": cost, "audit": audit}
        out, place = [], 0
        for k, (row, own, entry) in enumerate(zip(rows, edits, entries)):
            ends = k == len(rows) - 1
            own = own + audit[len("".join(edits)) :] if ends else own
            out.append({"conv_id": row["conv_id"], "part": row["part"], "entry": entry, "place": place, "edits": own} | (facts if ends else {}))
            place += len(own) - own.count("D")
        return pa.Table.from_pylist(out, table_schema)

    table_schema = arrow_schema(schema)
    return open_.select(names).groupBy("conv_id").applyInArrow(resolve, schema)


def chosen(sorted_rows: DataFrame) -> DataFrame:
    """(conv_id, part, entry, place, edits, facts..) of every stretch; the facts stand on the last stretch of a conversation. Stored."""
    schema = f"conv_id {dict(sorted_rows.dtypes)['conv_id']}, part int, entry int, place long, edits string, {FACTS}"
    names = [c.split()[0] for c in schema.split(", ")]
    ends = sorted_rows.where("nth = -1")
    done = ends.where("whole").select("conv_id", "part", F.lit(NOTHING).alias("entry"), F.lit(0).cast("long").alias("place"), F.col("chosen").alias("edits"), *names[5:])
    more = _resolved(ends.where("not whole").select("conv_id", "part", "ways", "initials", "turns", "distinct", "blank", "duplicate", "truncated", "illegal"), schema)
    return stored(done.unionByName(more), "edits")


def repaired(sorted_rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of the repaired conversations: the edits of each stretch, applied to its rows, wherever the stretch lies."""
    conv_type = dict(sorted_rows.dtypes)["conv_id"]
    some = sorted_rows.where("nth >= 0").select("conv_id", "part", "nth", "role", "text", "n", F.lit(None).cast("int").alias("entry"), F.lit(None).cast("long").alias("place"), F.lit(None).cast("string").alias("edits"))
    heads = edits.select("conv_id", "part", F.lit(-1).cast("long").alias("nth"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("long").alias("n"), "entry", "place", "edits")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        conv_id, state, place, todo, at = None, NOTHING, 0, "", 0

        def put(role: str, text: str, initial: str) -> None:
            nonlocal state, place
            out.append({"conv_id": conv_id, "place": place, "role": role, "text": text})
            state, place = GRAMMAR[state, initial], place + 1

        def fill() -> str:
            """What the grammar asks for next."""
            return next(role for role in ROLES if (state, role) in GRAMMAR)

        def insertions() -> None:
            nonlocal at
            while at < len(todo) and todo[at] == "I":
                put(ROLES[fill()], "", fill())
                at += 1

        for batch in batches:
            for row in batch.to_pylist():
                if row["nth"] < 0:
                    insertions()
                    conv_id, state, place, todo, at = row["conv_id"], row["entry"], row["place"], row["edits"], 0
                    continue
                for _ in range(row["n"]):
                    insertions()
                    if todo[at] == "K":
                        put(row["role"], row["text"], row["role"][:1])
                    elif todo[at] == "R":
                        put(ROLES[fill()], row["text"], fill())
                    at += 1
            yield from _batches(out, arrow)
            out.clear()
        insertions()
        yield from _batches(out, arrow)

    schema = f"conv_id {conv_type}, place long, role string, text string"
    arrow = arrow_schema(schema)
    return some.unionByName(heads).repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "nth").mapInArrow(apply, schema)


def hashes(rows: DataFrame) -> DataFrame:
    """(conv_id, sha256) of `role:text` of each conversation's rows by place, joined by line feeds. A task keeps a hash and no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, begun = [], None, False
        conv_id = None
        for batch in batches:
            for row in batch.to_pylist():
                if not begun or row["conv_id"] != conv_id:
                    if begun:
                        out.append({"conv_id": conv_id, "sha256": now.hexdigest()})
                    conv_id, now, begun = row["conv_id"], hashlib.sha256(), True
                else:
                    now.update(b"\n")
                now.update(f"{row['role']}:{row['text']}".encode())
            yield from _batches(out, arrow)
            out = []
        if begun:
            yield from _batches([{"conv_id": conv_id, "sha256": now.hexdigest()}], arrow)

    schema = f"conv_id {dict(rows.dtypes)['conv_id']}, sha256 string"
    arrow = arrow_schema(schema)
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(run, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(facts, repaired) of rows (conv_id, turn, role, text, n): one row (conv_id, gaps, .., audit) for each conversation that has rows, and the rows of the repaired conversations."""
    in_order = composed(judged_rows(rows))
    edits = chosen(in_order)
    facts = edits.where("audit is not null").drop("part", "entry", "place", "edits")
    return facts, repaired(in_order, edits)


def audited(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table after damage and repair: its faults, the cheapest edits and the hash of what they leave."""
    facts, left = repair(damaged(conversations))
    every = conversations.select(F.col("conv_id")).distinct()
    found = facts.withColumnRenamed("conv_id", "c")
    digests = hashes(left).withColumnRenamed("conv_id", "h")
    joined = every.join(found, every["conv_id"].eqNullSafe(found["c"]), "left")
    joined = joined.join(digests, joined["conv_id"].eqNullSafe(digests["h"]), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
