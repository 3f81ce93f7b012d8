"""Jaccard similarity join over word shingles by multiple-global-order filtering.

Two sets with a Jaccard similarity of t or more share a token within their prefixes under every global order of tokens, a
prefix being the first n - ceil(t n) + 1 tokens of a set of n. Several orders are used at once and a pair must pass all of them.

1. Texts are stored as files, and every row is named by its place there. Sets are hashed; rows of equal sets form a class, of which one row, the carrier, goes
   on. The same pass adds up a sketch of token frequencies, of fixed size.
2. Carriers send a share of their distinct tokens, picked by hash, to buckets and learn which occur in other classes. A set with more than n - ceil(t n) tokens that
   occur nowhere else is linked with nothing and goes no further; on most text that is nearly all of them.
3. An order sorts tokens that occur nowhere else first, then by the sketch's class of frequency, rare first, and then by a hash of its own, so
   that boilerplate stands last in every order. Prefix tokens of all orders are posted; classes that meet in a list and whose sizes and the parities of their
   token sets, which are kept in as many bits as a set's size asks for, allow a link are tied under that order. A class tells its first codes with each list, so that two that have one in common are
   tied by the list of that one alone and not once more for each part of the lists that they share. The pairs of a list are compared in arrays and never become rows of a table; a list of more
   than LONG_LIST classes is tied by a star.
4. The components of the ties under each order are intersected: classes that are in one component under every order are a group, outside which there are no
   links. Only now sets move.
5. A group is cut into bands by set size, since linked sets differ in size by a factor of t at most, and large bands
   into blocks that are met pairwise. Inside, the prefixes of all orders are intersected pair by pair, and what passes is verified
   on the whole sets. join_rows verifies every pair and adds up each class's links, times copies; cluster skips pairs whose ends are
   connected already. Both yield a spanning forest of each block's links.
6. Components over the forests of all blocks, and for join_rows the sums of links, are the result.

Links never become rows for all pairs of a group; none is lost for the components or the counts. Texts are never cut. A set of a group moves once for
each block of its band, so the traffic of a group grows with its size times its blocks, as does its number of links.

Defined results: a null or empty text, or one without words, has no shingles and stands alone; rows with a null id take part and
get the component's least non-null id, or null; repeated rows are copies; very long texts are read whole; an empty table gives no rows. Extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesets import mix, shingle_sets, slices
from .graph import components
from .shared import join_hot, release, stored, text_or_empty
from .textfiles import BLOBS, BUCKET_BYTES, blobs, by_bucket, meet, meet_keys, over_files, read_texts, replies_by_file, store_texts

SLOT_BITS = 18
SLOTS_A_ROW = 1 << 14
NULL_ID = -(1 << 63)
#: Rows of a file at most, so that a row's place in all files is file * ROWS_A_FILE + row; and nodes of a place, one for each order.
ROWS_A_FILE = 1 << 14
ORDERS_AT_MOST = 4


@dataclass(frozen=True)
class Join:
    """Links sets of n-word shingles when 100 * intersection >= percent * union; orders are the global orders."""

    n: int = 3
    percent: int = 90
    orders: int = 3
    block: int = 500_000  # shingles of a block

    def prefix(self, size: int) -> int:
        return size - -(-self.percent * size // 100) + 1

    def linked(self, common, a, b):
        return 100 * common >= self.percent * (a + b - common)


def set_key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def sets_of(data: np.ndarray, offsets: np.ndarray, rows: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, set) of these rows, in their order."""
    sizes = offsets[rows + 1] - offsets[rows]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    for lo, hi in slices(bounds):
        some = np.concatenate([data[a:b] for a, b in zip(offsets[rows[lo:hi]].tolist(), offsets[rows[lo:hi] + 1].tolist())])
        yield from zip(rows[lo:hi].tolist(), shingle_sets(some, bounds[lo : hi + 1] - bounds[lo], n))


def slot_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


SIGNED = "place long, id long, n_shingles long, key binary, slot int, counts binary"


def signatures(files: DataFrame, n_files: int, n: int) -> DataFrame:
    """A row (place, id, n_shingles, key) for each row of the files, and rows (slot, counts) of the frequency sketch."""
    schema = pa.schema([("place", pa.int64()), ("id", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("slot", pa.int32()), ("counts", pa.binary())])

    def sign(row: dict) -> Iterator[pa.RecordBatch]:
        ids, data, offsets = read_texts(row["uri"])
        sketch = np.zeros(1 << SLOT_BITS, np.uint32)
        sizes, keys = [], []
        for _, tokens in sets_of(data, offsets, np.arange(len(ids)), n):
            sizes.append(len(tokens))
            keys.append(set_key(tokens) if len(tokens) else None)
            np.add.at(sketch, slot_of(tokens), 1)
        none = [None] * len(sizes)
        yield pa.RecordBatch.from_arrays([pa.array(row["file"] * ROWS_A_FILE + np.arange(len(ids))), pa.array(ids), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(none, pa.int32()), pa.array(none, pa.binary())], schema=schema)
        parts = [(s, sketch[s : s + SLOTS_A_ROW]) for s in range(0, len(sketch), SLOTS_A_ROW)]
        parts = [(s, zlib.compress(x.astype("<u4").tobytes(), 1)) for s, x in parts if x.any()]
        none = [None] * len(parts)
        yield pa.RecordBatch.from_arrays([*(pa.array(none, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())), pa.array([s for s, _ in parts], pa.int32()), pa.array([x for _, x in parts], pa.binary())], schema=schema)

    return over_files(files, n_files, sign, SIGNED)


def frequency_classes(signed: DataFrame) -> np.ndarray:
    """For each slot of the sketch 0 where tokens are as frequent as the mean or not recognisably more, else a power of two above it."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(zlib.decompress(x), "<u4") for x in frame["counts"]], axis=0, dtype=np.uint64)
        return pd.DataFrame([(int(frame["slot"].iloc[0]), zlib.compress(total.astype("<u8").tobytes(), 1))], columns=["slot", "counts"])

    counts = np.zeros(1 << SLOT_BITS, np.float64)
    for row in signed.where("slot is not null").select("slot", "counts").groupBy("slot").applyInPandas(add, "slot int, counts binary").collect():
        counts[row["slot"] : row["slot"] + SLOTS_A_ROW] = np.frombuffer(zlib.decompress(row["counts"]), "<u8")
    usual = 4 + 2 * counts.mean()
    return np.maximum(0, np.ceil(np.log2(np.maximum(counts, 1) / usual))).astype(np.uint8)


# -- tokens that other classes have ------------------------------------------------------------------


def picked(tokens: np.ndarray, join: Join) -> np.ndarray:
    """Whether a token is in the share, by its hash, that is looked for in other classes: four times what a linked set may have of its own."""
    return (mix(tokens) >> np.uint64(56)) < np.uint64(min(256, -(-256 * 4 * (100 - join.percent) // 100)))


def distinct_tokens(sets: list[np.ndarray], join: Join) -> tuple[np.ndarray, np.ndarray]:
    """(the picked tokens of all sets, rising; whether several of the sets have each)."""
    if not sets:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    flat = np.concatenate(sets)
    values, counts = np.unique(flat[picked(flat, join)], return_counts=True)
    return values, counts > 1


def send_tokens(files: DataFrame, n_files: int, join: Join, buckets: int) -> DataFrame:
    """The picked tokens of the carriers of each file, in 32 bits, to their buckets."""

    def work(row: dict) -> Iterator[pa.RecordBatch]:
        _, data, offsets = read_texts(row["uri"])
        values, _ = distinct_tokens([s for _, s in sets_of(data, offsets, np.array(sorted(row["rows"]), np.int64), join.n)], join)
        out = [(row["file"], b, np.unique(short(values[at])).astype("<u4").tobytes()) for b, at in by_bucket(mix(values), buckets)]
        if out:
            yield blobs(out)

    return over_files(files, n_files, work, BLOBS)


def short(tokens: np.ndarray) -> np.ndarray:
    """32 bits of a token; within a bucket a coincidence only makes a token count as shared."""
    return (tokens >> np.uint64(16)).astype(np.uint32)


def alone(values: np.ndarray, many: np.ndarray, replies: list[dict], buckets: int) -> np.ndarray:
    """Those of a file's picked tokens that no other class has."""
    told = {x["bucket"]: x["data"] for x in replies or ()}
    out = []
    for b, at in by_bucket(mix(values), buckets):
        sent, where = np.unique(short(values[at]), return_inverse=True)
        # tokens of one file that coincide in 32 bits count as shared
        shared = np.unpackbits(np.frombuffer(told[b], np.uint8), count=len(sent)).astype(bool) | (np.bincount(where) > 1)
        out.append(values[at[~shared[where] & ~many[at]]])
    return np.sort(np.concatenate(out)) if out else values[:0]


def among(sorted_values: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(tokens), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, tokens), len(sorted_values) - 1)] == tokens


# -- orders, prefixes and ties -------------------------------------------------------------------------


def prefixes(tokens: np.ndarray, classes: np.ndarray, join: Join, first: np.ndarray | None = None) -> list[np.ndarray]:
    """The prefix of a set under each order; tokens marked in first come before all others."""
    rank = classes[slot_of(tokens)].astype(np.uint64) + np.uint64(1)
    if first is not None:
        rank[first] = 0
    rank <<= np.uint64(56)
    k, out = join.prefix(len(tokens)), []
    for order in range(join.orders):
        key = rank | (in_order(tokens, order) >> np.uint64(8))
        out.append(tokens[np.argpartition(key, k - 1)[:k]] if k < len(tokens) else tokens)
    return out


def in_order(tokens: np.ndarray, order: int) -> np.ndarray:
    """What sorts tokens of equal rank under an order."""
    return mix(tokens + np.uint64(order * 0x632BE59BD9B4E019 & (1 << 64) - 1))


TIED = "u long, v long"
PARITY_BITS = 128
#: An entry of a posting list: the token under its order, the class's node of that order, its set's size and the parity of its tokens by their last bits.
ENTRY = np.dtype([("token", "<u4"), ("node", "<i8"), ("size", "<u4"), ("parity", "<u8", PARITY_BITS // 64)])
LONG_LIST = 4096
#: The least codes of a prefix under its order, by node; fewer are filled up with NO_CODE.
FIRST = np.dtype([("node", "<i8"), ("codes", "<u8", 4)])
NO_CODE = np.uint64(0xFFFFFFFFFFFFFFFF)


def first_codes(code: np.ndarray) -> np.ndarray:
    out = np.full(4, NO_CODE)
    some = np.partition(code, 3)[:4] if len(code) > 4 else code
    out[: len(some)] = some
    return out


def here(first: np.ndarray, x: np.ndarray, y: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Whether pairs of nodes that meet in the list of token are tied there: where they have first codes in common, only the list of the least one ties them."""
    a, b = (first["codes"][np.searchsorted(first["node"], n)] for n in (x, y))
    both = (a[:, :, None] == b[:, None, :]).any(axis=2)
    least = np.where(both, a, NO_CODE).min(axis=1)
    return (least == NO_CODE) | ((least & np.uint64(0xFFFFFFFF)) == token)


def parity(tokens: np.ndarray, bits: int = PARITY_BITS) -> np.ndarray:
    """Of each value of the last bits, whether an odd number of tokens has it: two sets differ in at least as many tokens as parities."""
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view("<u8")


def sign_words(size: int) -> int:
    """Words of 64 bits of a set's own parity, a power of two: sets that have nothing to do with each other differ in half of the bits, which only tells where there are about as many bits as tokens."""
    return max(PARITY_BITS // 64, 1 << (-(-size // 100) - 1).bit_length())


class Signs:
    """The parities of large sets at their own widths, by place. A blob of them has places, sizes and words; the words of a width that is twice another's fold into it."""

    def __init__(self, blobs: list[bytes] = ()):
        found: dict[int, tuple[list, list]] = {}
        for blob in blobs:
            (n,) = np.frombuffer(blob, "<i8", 1)
            places, sizes, at = np.frombuffer(blob, "<i8", n, 8), np.frombuffer(blob, "<i8", n, 8 + 8 * n), 8 + 16 * int(n)
            for place, size in zip(places.tolist(), sizes.tolist()):
                width = sign_words(size)
                held = found.setdefault(width, ([], []))
                held[0].append(place)
                held[1].append(np.frombuffer(blob, "<u8", width, at))
                at += 8 * width
        self.levels = {}
        for width, (places, words) in found.items():
            by = np.argsort(np.array(places, np.int64))
            self.levels[width] = np.array(places, np.int64)[by], np.stack(words)[by]

    @staticmethod
    def blob(signs: list[tuple[int, int, bytes]]) -> bytes:
        """Signs (place, size, words) as one blob."""
        return np.array([len(signs)] + [p for p, _, _ in signs] + [n for _, n, _ in signs], "<i8").tobytes() + b"".join(w for _, _, w in signs)

    def _rows(self, places: np.ndarray, width: int, to: int) -> np.ndarray:
        names, words = self.levels[width]
        return np.bitwise_xor.reduce(words[np.searchsorted(names, places)].reshape(len(places), width // to, to), axis=1)

    def near(self, u: np.ndarray, v: np.ndarray, size_u: np.ndarray, size_v: np.ndarray, percent: int) -> np.ndarray:
        """Whether the sets at places u and v, of these sizes and u the smaller ones, may be linked."""
        ok = np.ones(len(u), bool)
        widths = np.stack([np.fromiter(map(sign_words, x.tolist()), np.int64, len(x)) for x in (size_u, size_v)], axis=1)
        for a, b in np.unique(widths, axis=0).tolist():
            if a == PARITY_BITS // 64:
                continue  # the entries tell as much
            mine = np.flatnonzero((widths[:, 0] == a) & (widths[:, 1] == b))
            for lo in range(0, len(mine), max(1, (1 << 20) // b)):
                some = mine[lo : lo + max(1, (1 << 20) // b)]
                apart = np.bitwise_count(self._rows(u[some], a, a) ^ self._rows(v[some], b, a)).sum(axis=1, dtype=np.int64)
                ok[some] = apart * (100 + percent) <= (100 - percent) * (size_u[some] + size_v[some])
        return ok


def close_pairs(entries: np.ndarray, percent: int, signs: Signs | None = None, first: np.ndarray | None = None) -> np.ndarray:
    """Edges between classes that share a token and may be linked by their sizes and parities; lists that are very long are tied by a star instead."""
    entries = entries[np.lexsort((entries["size"], entries["token"]))]
    token, node, size, bits = entries["token"], entries["node"], entries["size"].astype(np.int64), entries["parity"]
    if not len(token):
        return np.zeros((0, 2), np.int64)
    head = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    length = np.diff(head, append=len(token))
    long = np.repeat(length > LONG_LIST, length)
    out = [np.stack([node[long], np.repeat(node[head], length)[long]], axis=1)]
    at, d = np.flatnonzero(~long[:-1] & (token[1:] == token[:-1])), 1
    while len(at):
        at = at[at + d < len(token)]
        to = at + d
        # sizes rise within a list, so a pair too far apart ends the row
        near = (token[at] == token[to]) & (100 * size[at] >= percent * size[to])
        at, to = at[near], to[near]
        apart = np.bitwise_count(bits[at] ^ bits[to]).sum(axis=1, dtype=np.int64)
        ok = (apart * (100 + percent) <= (100 - percent) * (size[at] + size[to])) & (node[at] != node[to])
        x, y = at[ok], to[ok]
        if first is not None:
            tied = np.concatenate([here(first, node[x[lo : lo + (1 << 18)]], node[y[lo : lo + (1 << 18)]], token[x[lo : lo + (1 << 18)]]) for lo in range(0, len(x), 1 << 18)] or [np.zeros(0, bool)])
            x, y = x[tied], y[tied]
        if len(x):
            found, one = np.unique(np.stack([node[x], node[y]], axis=1), axis=0, return_index=True)
            if signs is not None:
                found = found[signs.near(*(found // ORDERS_AT_MOST).T, size[x[one]], size[y[one]], percent)]
            out.append(found)
        d += 1
    return np.unique(np.concatenate(out), axis=0)


def spanning_stars(edges: np.ndarray) -> np.ndarray:
    """Edges from every node to the least node of its component: as many as nodes, whatever the number of edges."""
    nodes, ends = np.unique(edges, return_inverse=True)
    ends = ends.reshape(edges.shape)
    root = np.arange(len(nodes))
    while True:
        a, b = root[ends[:, 0]], root[ends[:, 1]]
        if (a == b).all():
            break
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    return np.stack([nodes, nodes[root]], axis=1)[root != np.arange(len(nodes))]


POSTED = "part long, data binary, signs binary, first binary, place long"


def post(files: DataFrame, n_files: int, classes: np.ndarray, join: Join, buckets: int, parts: int) -> DataFrame:
    """Rows (part, data) of posting lists under all orders, and a row (place) for each carrier that may be linked with another."""
    shared = files.sparkSession.sparkContext.broadcast(classes)
    schema = pa.schema([("part", pa.int64()), ("data", pa.binary()), ("signs", pa.binary()), ("first", pa.binary()), ("place", pa.int64())])

    def work(row: dict) -> Iterator[pa.RecordBatch]:
        release()
        _, data, offsets = read_texts(row["uri"])
        rows = np.array(sorted(row["rows"]), np.int64)
        values, many = distinct_tokens([s for _, s in sets_of(data, offsets, rows, join.n)], join)
        lonely = alone(values, many, row["replies"], buckets)
        held: list[np.ndarray] = []
        lists: list[np.ndarray] = []
        live: list[int] = []
        signed: dict[int, tuple[int, int, bytes]] = {}
        first: dict[int, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                entries, place = np.concatenate(held), np.concatenate(lists)
                at = np.argsort(place, kind="stable")
                entries, place = entries[at], place[at]
                bounds = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]]))
                for a, b in zip(bounds, bounds[1:]):
                    nodes = np.unique(entries["node"][a:b])
                    signs = [signed[p] for p in np.unique(nodes // ORDERS_AT_MOST).tolist() if p in signed]
                    least = np.empty(len(nodes), FIRST)
                    least["node"], least["codes"] = nodes, np.stack([first[x] for x in nodes.tolist()])
                    yield pa.RecordBatch.from_arrays([pa.array([place[a]], pa.int64()), *(pa.array([x], pa.binary()) for x in (entries[a:b].tobytes(), Signs.blob(signs), least.tobytes())), pa.array([None], pa.int64())], schema=schema)
            none = pa.array([None] * len(live), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([None] * len(live), pa.int64()), none, none, none, pa.array(live, pa.int64())], schema=schema)
            held.clear()
            lists.clear()
            live.clear()
            signed.clear()
            first.clear()

        n = 0
        for r, s in sets_of(data, offsets, rows, join.n):
            own = among(lonely, s)
            if not len(s) or own.sum() >= join.prefix(len(s)):
                continue
            place, bits = row["file"] * ROWS_A_FILE + r, parity(s)
            live.append(place)
            if (width := sign_words(len(s))) > PARITY_BITS // 64:
                signed[place] = place, len(s), parity(s, 64 * width).tobytes()
            for order, prefix in enumerate(prefixes(s, shared.value, join, own)):
                prefix = prefix[~among(lonely, prefix)]
                code = in_order(prefix, order)
                first[place * ORDERS_AT_MOST + order] = first_codes(code)
                entry = np.empty(len(prefix), ENTRY)
                entry["token"], entry["node"], entry["size"], entry["parity"] = (code & np.uint64(0xFFFFFFFF)), place * ORDERS_AT_MOST + order, len(s), bits
                held.append(entry)
                lists.append(((code >> np.uint64(32)) % np.uint64(parts)).astype(np.int64))
                n += len(prefix)
            if n > 500_000:
                yield from out()
                n = 0
        yield from out()

    return over_files(files, n_files, work, POSTED)


def ties(posted: DataFrame, percent: int, parts: int) -> DataFrame:
    """Edges (u, v) between nodes of one order that share a prefix token under it and are close enough in size and parity."""

    def meet_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, signs, first = None, [], [], []

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                edges = spanning_stars(close_pairs(np.concatenate(held), percent, Signs(signs), np.sort(np.concatenate(first), order="node")))
                yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["u", "v"])

        for batch in batches:
            for p, blob, sign, least in zip(batch.column("part").to_pylist(), batch.column("data"), batch.column("signs"), batch.column("first")):
                if p != part:
                    yield from out()
                    part, held, signs, first = p, [], [], []
                held.append(np.frombuffer(blob.as_buffer(), ENTRY))
                first.append(np.frombuffer(least.as_buffer(), FIRST))
                signs.append(sign.as_buffer())
        yield from out()

    return posted.where("part is not null").select("part", "data", "signs", "first").repartition(parts, "part").sortWithinPartitions("part").mapInArrow(meet_lists, TIED)


class Forest:
    """Union-find over 0 .. n - 1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def common_counts(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many members of each of others are in one; all are sorted and not empty."""
    sizes = np.fromiter(map(len, others), np.int64, len(others))
    flat = np.concatenate(others)
    same = one[np.minimum(np.searchsorted(one, flat), len(one) - 1)] == flat
    return np.add.reduceat(same.astype(np.int64), np.cumsum(sizes) - sizes)


def spanning_links(sets: list[np.ndarray], sides: list[int], classes: np.ndarray, join: Join) -> list[tuple[int, int]]:
    """Links among sets that connect what all links connect. With two sides, only pairs across them are compared."""
    across = len(set(sides)) > 1
    forest, links = Forest(len(sets)), []
    #: of a token under the first order: its members by the tree that they were in when they came, and by side
    index: dict[int, dict[tuple[int, int], list[int]]] = {}
    prefix = [[np.sort(p) for p in prefixes(s, classes, join)] for s in sets]
    for x in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        n, mine = len(sets[x]), forest.find(x)
        tokens = prefix[x][0].tolist()
        rivals: dict[int, list[int]] = {}
        for token in tokens:
            for (root, side), members in index.get(token, {}).items():
                if (not across or side != sides[x]) and (r := forest.find(root)) != mine:
                    rivals.setdefault(r, []).extend(members)
        for r, members in rivals.items():
            if forest.find(r) == forest.find(x):
                continue
            members = [y for y in dict.fromkeys(reversed(members)) if 100 * len(sets[y]) >= join.percent * n]
            lo, step = 0, 4
            while lo < len(members):
                some = members[lo : lo + step]
                lo, step = lo + step, min(step * 4, 256)
                for k in range(1, join.orders):
                    if some:
                        shared = common_counts(prefix[x][k], [prefix[y][k] for y in some])
                        some = [y for y, c in zip(some, shared.tolist()) if c]
                if not some:
                    continue
                common = common_counts(sets[x], [sets[y] for y in some])
                hit = np.flatnonzero(join.linked(common, np.array([len(sets[y]) for y in some]), n))
                if len(hit):
                    y = some[int(hit[0])]
                    links.append((x, y))
                    forest.union(x, y)
                    break
        root = forest.find(x)
        for token in tokens:
            index.setdefault(token, {}).setdefault((root, sides[x] if across else 0), []).append(x)
    return links


def every_link(sets: list[np.ndarray], sides: list[int], homes: list[bool], copies: list[int], inner: bool, classes: np.ndarray, join: Join) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that connect what all links connect, and for each set the copies of all sets linked to it.

    An inner block compares all its pairs, another only those across its sides. Bands overlap, so a pair counts
    only where one of its ends is at home, which is in one band.
    """
    forest, links, counts = Forest(len(sets)), [], np.zeros(len(sets), np.int64)
    index: dict[int, list[int]] = {}
    prefix = [[np.sort(p) for p in prefixes(s, classes, join)] for s in sets]
    sizes, side = np.array([len(s) for s in sets]), np.array(sides)
    home, weight = np.array(homes, bool), np.array(copies, np.int64)
    for x in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        tokens = prefix[x][0].tolist()
        rivals = np.array(sorted({y for t in tokens for y in index.get(t, ())}), np.int64)
        if len(rivals):
            ok = (100 * sizes[rivals] >= join.percent * sizes[x]) & (home[rivals] | home[x])
            rivals = rivals[ok if inner else ok & (side[rivals] != side[x])]
        for lo in range(0, len(rivals), 256):
            some = rivals[lo : lo + 256]
            for k in range(1, join.orders):
                if len(some):
                    some = some[common_counts(prefix[x][k], [prefix[y][k] for y in some]) > 0]
            if len(some):
                some = some[join.linked(common_counts(sets[x], [sets[y] for y in some]), sizes[some], sizes[x])]
            counts[some] += weight[x]
            counts[x] += weight[some].sum()
            links += [(x, y) for y in some.tolist() if forest.union(x, y)]
        for token in tokens:
            index.setdefault(token, []).append(x)
    return links, counts


# -- groups and verification ---------------------------------------------------------------------------


def _tasks(members: DataFrame, join: Join) -> DataFrame:
    """members(gathered, place, n_shingles, ..) with task and side: bands by size, cut into blocks of about join.block shingles that meet pairwise."""
    band = F.floor(F.log(F.col("n_shingles")) / F.log(F.lit(100 / join.percent) * (1 + 1e-9)))
    banded = members.withColumn("band", F.explode(F.array(band, band - 1))).withColumn("home", F.col("band") == band)
    counts = banded.groupBy("gathered", "band").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total")).where("n > 1").select("gathered", "band", F.ceil(F.col("total") / join.block).alias("blocks"))
    met = banded.join(counts.hint("merge"), ["gathered", "band"]).withColumn("own", F.pmod(F.xxhash64("place"), F.col("blocks")))
    spread = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return spread.withColumn("task", F.xxhash64("gathered", "band", F.least("own", "other"), F.greatest("own", "other"))).withColumn("side", F.when(F.col("own") <= F.col("other"), 0).otherwise(1)).withColumn("inner", F.col("own") == F.col("other"))


MEMBERS = "task long, side int, home boolean, inner boolean, copies long, place long, tokens binary"


def member_sets(files: DataFrame, n_files: int, join: Join) -> DataFrame:
    """The sets of the members of all tasks, from files(file, uri, members of its rows)."""

    def work(row: dict) -> Iterator[pa.RecordBatch]:
        release()
        _, data, offsets = read_texts(row["uri"])
        wanted: dict[int, list[dict]] = {}
        for m in row["members"]:
            wanted.setdefault(m["place"] % ROWS_A_FILE, []).append(m)
        out, size = [], 0
        for r, s in sets_of(data, offsets, np.array(sorted(wanted), np.int64), join.n):
            for m in wanted[r]:
                out.append((m["task"], m["side"], m["home"], m["inner"], m["copies"], m["place"], s.astype("<u8").tobytes()))
                size += 8 * len(s)
                if size > 4 << 20:
                    yield _members(out)
                    out, size = [], 0
        yield _members(out)

    return over_files(files, n_files, work, MEMBERS)


def _members(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=[c.split()[0] for c in MEMBERS.split(", ")])


def _by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, list[tuple]]]:
    """(inner, [(set, side, home, copies, place)]) of each task, from rows sorted by it."""
    task, inner, held = None, True, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("task", "side", "home", "inner", "copies", "place", "tokens")]
        for t, side, home, within, copies, place, tokens in zip(*columns):
            if t != task:
                if len(held) > 1:
                    yield inner, held
                task, inner, held = t, within, []
            held.append((np.frombuffer(tokens, "<u8"), side, home, copies, place))
    if len(held) > 1:
        yield inner, held


COUNTED = "u long, v long, n long"


def links(members: DataFrame, classes: np.ndarray, join: Join, counted: bool) -> DataFrame:
    """Links (u, v) between places that connect what all links of each task connect; if counted, also rows (u, null, n) with the rows linked to a class."""
    shared = members.sparkSession.sparkContext.broadcast(classes)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for inner, held in _by_task(batches):
            sets, sides, homes, copies, places = map(list, zip(*held))
            if counted:
                found, counts = every_link(sets, sides, homes, copies, inner, shared.value, join)
                some = np.flatnonzero(counts).tolist()
                numbers = counts[some].tolist()
            else:
                found, some, numbers = spanning_links(sets, sides, shared.value, join), [], []
            u = [places[x] for x, _ in found] + [places[x] for x in some]
            v = [places[y] for _, y in found] + [None] * len(some)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array([None] * len(found) + numbers, pa.int64())], names=["u", "v", "n"])

    return members.repartition("task").sortWithinPartitions("task", "place").mapInArrow(solve, COUNTED)


def _solve(docs: DataFrame, join: Join, id_col: str, text_col: str, counted: bool) -> DataFrame:
    """(id, n_shingles, component_id, copies, others) of every row; others, if counted, are the rows linked to it that have other sets."""
    if join.orders > ORDERS_AT_MOST:
        raise ValueError(f"at most {ORDERS_AT_MOST} orders")
    # tables grow with the corpus and pack well on disk, so that Spark would take them for small and collect them on the driver: they are joined by sort and merge
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), text_or_empty(text_col).alias("text"))
    manifest = store_texts(rows, ROWS_A_FILE).select("file", "uri", "rows", "bytes")
    n, total, size = manifest.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    files = manifest.select("file", "uri")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    buckets = max(parts, -(-size // BUCKET_BYTES))

    signed = stored(signatures(files.coalesce(1), n, join.n), "signatures")
    classes = frequency_classes(signed)
    signed = signed.where("slot is null").select("place", "id", "n_shingles", "key")
    doc = F.when(F.col("id") != NULL_ID, F.col("id"))
    sets = stored(signed.where("key is not null").groupBy("key").agg(F.min("place").alias("place"), F.first("n_shingles").alias("n_shingles"), F.count(F.lit(1)).alias("n"), F.min(doc).alias("least")), "classes")

    carriers = sets.groupBy(F.expr(f"place div {ROWS_A_FILE}").alias("file")).agg(F.collect_list(F.expr(f"place % {ROWS_A_FILE}")).alias("rows"))
    carrying = stored(files.join(carriers.hint("merge"), "file"), "carriers")
    told = replies_by_file(meet(send_tokens(carrying, n, join, buckets), buckets, meet_keys("<u4")))
    posted = stored(post(carrying.join(told.hint("merge"), "file", "left"), n, classes, join, buckets, parts), "postings")

    gathered = components(ties(posted, join.percent, parts))
    live = posted.where("place is not null").select("place")
    nodes = live.select("place", F.explode(F.sequence(F.lit(0), F.lit(join.orders - 1))).alias("order")).withColumn("node", F.col("place") * ORDERS_AT_MOST + F.col("order"))
    # one group is one component under every order
    where = nodes.join(gathered.hint("merge"), "node").groupBy("place").agg(F.array_sort(F.collect_list("component")).alias("under")).where(F.size("under") == join.orders)
    several = where.groupBy(F.xxhash64("under").alias("gathered")).agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("gathered")
    members = where.select("place", F.xxhash64("under").alias("gathered")).join(several.hint("merge"), "gathered").join(sets.select("place", "n_shingles", F.col("n").alias("copies")).hint("merge"), "place")
    tasks = _tasks(stored(members, "candidates"), join)
    asked = tasks.groupBy(F.expr(f"place div {ROWS_A_FILE}").alias("file")).agg(F.collect_list(F.struct("place", "task", "side", "home", "inner", "copies")).alias("members"))
    found = stored(links(member_sets(files.join(asked.hint("merge"), "file"), n, join), classes, join, counted), "links")

    joined = components(found.where("v is not null").select("u", "v"))
    others = found.where("v is null").groupBy("u").agg(F.sum("n").alias("others")).withColumnRenamed("u", "place")
    rooted = stored(sets.join(joined.withColumnRenamed("node", "place").hint("merge"), "place", "left").withColumn("root", F.coalesce("component", "place")).join(others.hint("merge"), "place", "left").select("key", "root", "least", "n", "others"), "roots")
    roots = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    named = join_hot(rooted.withColumnRenamed("n", "copies"), roots, "root", ["key"], total).select("key", "component_id", "others", "copies", F.col("copies").alias("n"))
    some = join_hot(signed.where("key is not null"), named, "key", ["place"], total).select(doc.alias("id"), "n_shingles", "component_id", "copies", "others")
    rest = signed.where("key is null").select(doc.alias("id"), "n_shingles", doc.alias("component_id"), F.lit(1).cast("long").alias("copies"), F.lit(None).cast("long").alias("others"))
    return some.unionByName(rest)


def join_rows(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, n_links) of every row of docs. All links are verified; n_links counts the other rows linked to the row, copies too."""
    return _solve(docs, join, id_col, text_col, True).select("id", "n_shingles", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))


def cluster(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row of docs, from links that connect what all links connect."""
    return _solve(docs, join, id_col, text_col, False).select("id", "n_shingles", "component_id")
