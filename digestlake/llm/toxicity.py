"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as two vectors: an embedding of the whole word, and the mean embedding of its character triples, both
hashed. Two gated recurrent layers read a window of words in either direction, attention pools their states, and a logistic unit scores the window. A text
is covered by overlapping windows from its first word to its last, each of which is scored; the text's score is its highest
window's. Inputs are the words alone.

Training takes whole labelled texts, at most max_toxic and max_clean of them, chosen by a hash of their id. It alternates between picking each
text's highest window under the present weights and descending on the picked windows. A part of the
sample is kept apart to set the bias, so that 0.5 is the best cut.

Scoring passes over each text once, in arrays over its bytes; memory is bounded by a slice of texts.

Defined results: a null text is empty; a text without words has the score of an empty window; without labels of both kinds
every score is the share of toxic labels, or 0; null doc_ids and repeated rows are scored like others; an empty table gives no rows. Very long texts
are scored whole; extra columns are ignored by judge and kept by clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bytesets import BYTE, LOWER_WIDE, PLAIN, prefix_hashes, slices, span_hashes, text_bytes, words
from .shared import stored, text_or_empty

WORD_BITS, CHAR_BITS = 15, 12
WORD_DIM, CHAR_DIM, HIDDEN, ATTEND = 12, 8, 8, 8
WINDOW, STRIDE = 32, 16
TABLE = BYTE[LOWER_WIDE]
_TRIPLE = np.random.default_rng(7).integers(0, 1 << 32, (3, 256), np.uint32)


def read_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word code of each word, triple code of each byte in words, each word's first such byte, first word of each row)."""
    starts, ends, first = words(data, offsets, PLAIN)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), first
    codes = (span_hashes(prefix_hashes(data, TABLE), starts, ends) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    lowered = np.where(PLAIN[data], LOWER_WIDE[data], 0).astype(np.uint8)
    before, after = np.concatenate([[0], lowered[:-1]]).astype(np.uint8), np.concatenate([lowered[1:], [0]]).astype(np.uint8)
    # triples end where a row does
    some = offsets[1:] > offsets[:-1]
    before[offsets[:-1][some]] = after[offsets[1:][some] - 1] = 0
    mixed = _TRIPLE[0][before] + _TRIPLE[1][lowered] + _TRIPLE[2][after]
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    sizes = ends - starts
    begin = np.cumsum(sizes) - sizes
    at = np.repeat(starts - begin, sizes) + np.arange(int(sizes.sum()))
    return codes, (mixed[at] >> np.uint32(32 - CHAR_BITS)).astype(np.int64), begin, first


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, number of words) of the windows over rows with words; the last window of a row ends with its last word."""
    counts = np.diff(first)
    n = np.where(counts > 0, np.maximum(1, 1 + -(-(counts - WINDOW) // STRIDE)), 0)
    row = np.repeat(np.arange(len(counts)), n)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = np.minimum(nth * STRIDE, np.maximum(counts[row] - WINDOW, 0))
    return row, first[row] + start, np.minimum(counts[row], WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale=0.3: (rng.standard_normal(shape) * scale).astype(np.float32)
        inputs = WORD_DIM + CHAR_DIM
        self.p = {"words": normal(1 << WORD_BITS, WORD_DIM, scale=0.1), "chars": normal(1 << CHAR_BITS, CHAR_DIM, scale=0.1)}
        for d in "fb":
            self.p |= {f"x{d}": normal(inputs, 3 * HIDDEN), f"h{d}": normal(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"a": normal(2 * HIDDEN, ATTEND), "ab": np.zeros(ATTEND, np.float32), "av": normal(ATTEND), "o": normal(2 * HIDDEN), "ob": np.zeros(1, np.float32)}

    def word_inputs(self, codes: np.ndarray, chars: np.ndarray, begin: np.ndarray) -> np.ndarray:
        sizes = np.diff(begin, append=len(chars))
        mean = np.add.reduceat(self.p["chars"][chars], begin, axis=0) / sizes[:, None].astype(np.float32)
        return np.concatenate([self.p["words"][codes], mean], axis=1)

    def project(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        """What the words send to the gates of either direction."""
        return {d: inputs @ self.p[f"x{d}"] + self.p[f"c{d}"] for d in "fb"}

    def run(self, projections: dict[str, np.ndarray], at: np.ndarray, size: np.ndarray, keep: bool = False):
        """Logits of the windows over words at[i] .. at[i] + size[i] - 1; with keep also what going back needs."""
        n, p = len(at), self.p
        steps = int(size.max(initial=0))
        place = at[:, None] + np.arange(steps)
        there = np.arange(steps) < size[:, None]
        place = np.where(there, place, 0)
        states, kept = np.zeros((steps, n, 2 * HIDDEN), np.float32), {}
        full = size == steps
        for d in "fb":
            projected = projections[d]
            h = np.zeros((n, HIDDEN), np.float32)
            cells = []
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                x = projected[place[:, t]]
                u = h @ p[f"h{d}"]
                zr = _sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
                new = c + z * (h - c)
                if not full.all():
                    new = np.where(there[:, t, None], new, h)
                if keep:
                    cells.append((t, h, z, r, c, u[:, 2 * HIDDEN :]))
                h = new
                states[t, :, (0 if d == "f" else HIDDEN) : (HIDDEN if d == "f" else 2 * HIDDEN)] = h
            kept[d] = cells
        e = np.tanh(states @ p["a"] + p["ab"])
        score = np.where(there.T, e @ p["av"], -1e9)
        weight = np.exp(score - score.max(axis=0, initial=-1e9))
        weight = np.where(there.T, weight, 0)
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnk->nk", weight, states)
        logit = pooled @ p["o"] + p["ob"][0]
        return (logit, (place, there, states, e, weight, pooled, kept)) if keep else logit

    def back(self, codes, chars, begin, inputs, cache, slope: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the parameters, given the slope of the loss at each logit."""
        place, there, states, e, weight, pooled, kept = cache
        p, g = self.p, {}
        g["o"], g["ob"] = pooled.T @ slope, np.array([slope.sum()], np.float32)
        d_pool = slope[:, None] * p["o"]
        d_weight = np.einsum("nk,tnk->tn", d_pool, states)
        d_states = weight[:, :, None] * d_pool
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_e = d_score[:, :, None] * p["av"] * (1 - e * e)
        g["av"] = np.einsum("tn,tnk->k", d_score, e)
        g["a"], g["ab"] = np.einsum("tnk,tna->ka", states, d_e), d_e.sum(axis=(0, 1))
        d_states = d_states + d_e @ p["a"].T
        d_inputs = np.zeros_like(inputs)
        for d in "fb":
            own = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, 2 * HIDDEN)
            g[f"h{d}"], d_h = np.zeros_like(p[f"h{d}"]), np.zeros((len(slope), HIDDEN), np.float32)
            d_proj = np.zeros((len(inputs), 3 * HIDDEN), np.float32)
            for t, h, z, r, c, u in reversed(kept[d]):
                d_new = d_h + d_states[t][:, own]
                m = there[:, t, None]
                live = np.where(m, d_new, 0)
                d_c = live * (1 - z) * (1 - c * c)
                d_z = live * (h - c) * z * (1 - z)
                d_r = d_c * u * r * (1 - r)
                d_u = np.concatenate([d_z, d_r, d_c * r], axis=1)
                g[f"h{d}"] += h.T @ d_u
                d_h = np.where(m, live * z + d_u @ p[f"h{d}"].T, d_new)
                np.add.at(d_proj, place[:, t], np.concatenate([d_z, d_r, d_c], axis=1))
            g[f"x{d}"], g[f"c{d}"] = inputs.T @ d_proj, d_proj.sum(axis=0)
            d_inputs += d_proj @ p[f"x{d}"].T
        g["words"], g["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
        np.add.at(g["words"], codes, d_inputs[:, :WORD_DIM])
        sizes = np.diff(begin, append=len(chars))
        np.add.at(g["chars"], chars, np.repeat(d_inputs[:, WORD_DIM:] / sizes[:, None], sizes, axis=0))
        return g

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The highest window's logit of each row."""
        codes, chars, begin, first = read_words(data, offsets)
        out = np.full(len(offsets) - 1, self.p["ob"][0], np.float32)
        if len(codes):
            projections = self.project(self.word_inputs(codes, chars, begin))
            row, at, size = windows(first)
            logit = np.empty(len(at), np.float32)
            for part in (np.flatnonzero(size == WINDOW), np.flatnonzero(size < WINDOW)):
                for lo in range(0, len(part), 4096):
                    some = part[lo : lo + 4096]
                    logit[some] = self.run(projections, at[some], size[some])
            head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            out[row[head]] = np.maximum.reduceat(logit, head)
        return out


class _Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.01):
        self.rate, self.n = rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def step(self, p: dict[str, np.ndarray], g: dict[str, np.ndarray]) -> None:
        self.n += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.n) / (1 - 0.9**self.n)
        for k, x in g.items():
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.001 * (x * x - self.v[k])
            p[k] -= (rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(np.float32)


def _log_odds(pairs: np.ndarray, label: np.ndarray, fit: np.ndarray, bits: int) -> np.ndarray:
    """For each code, the smoothed log odds that a text with it is toxic against one that is not, from distinct row * 2**bits + code, over the rows in fit."""
    pairs = pairs[fit[pairs >> bits]]
    code, toxic = pairs & ((1 << bits) - 1), label[pairs >> bits] == 1
    a, b = np.bincount(code[toxic], minlength=1 << bits), np.bincount(code[~toxic], minlength=1 << bits)
    return np.log((a + 1) / (label[fit].sum() + 2)) - np.log((b + 1) / ((1 - label[fit]).sum() + 2))


class _Sample:
    """Texts as compact arrays of codes; windows are numbered over all texts."""

    def __init__(self, texts: list[str]):
        raw = [t.encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
        codes, chars, begin, first, words_of, chars_of = [], [], [], [], [], []
        for lo, hi in slices(offsets):
            c, x, b, f = read_words(np.frombuffer(b"".join(raw[lo:hi]), np.uint8), offsets[lo : hi + 1] - offsets[lo])
            row = lo + np.repeat(np.arange(hi - lo), np.diff(f))
            words_of.append(np.unique(row << WORD_BITS | c))
            chars_of.append(np.unique(np.repeat(row, np.diff(b, append=len(x))) << CHAR_BITS | x))
            begin.append(b + sum(map(len, chars)))
            first.append(f[:-1] + sum(map(len, codes)))
            codes.append(c.astype(np.int32))
            chars.append(x.astype(np.uint16))
        self.codes, self.chars, self.words_of, self.chars_of = map(np.concatenate, (codes, chars, words_of, chars_of))
        self.bounds = np.append(np.concatenate(begin), len(self.chars))
        self.row, self.at, self.size = windows(np.append(np.concatenate(first), len(self.codes)))

    def logits(self, net: Network, some: np.ndarray | None = None) -> np.ndarray:
        """The windows' logits, a few thousand windows at a time."""
        some = np.arange(len(self.at)) if some is None else some
        out = np.empty(len(some), np.float32)
        for lo in range(0, len(some), 2048):
            part = some[lo : lo + 2048]
            a, b = int(self.at[part].min()), int((self.at[part] + self.size[part]).max())
            x, y = self.bounds[a], self.bounds[b]
            inputs = net.word_inputs(self.codes[a:b], self.chars[x:y], self.bounds[a:b] - x)
            out[lo : lo + 2048] = net.run(net.project(inputs), self.at[part] - a, self.size[part])
        return out

    def gathered(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(codes, chars, begin, at, size) of the words of these windows alone."""
        n = self.size[some]
        after = np.cumsum(n)
        word = np.repeat(self.at[some] - (after - n), n) + np.arange(after[-1])
        m = self.bounds[word + 1] - self.bounds[word]
        end = np.cumsum(m)
        byte = np.repeat(self.bounds[word] - (end - m), m) + np.arange(end[-1])
        return self.codes[word], self.chars[byte], end - m, after - n, n


def train(texts: list[str], label: np.ndarray, epochs: int = 6, passes: int = 2, batch: int = 128, seed: int = 5) -> Network | None:
    """A network for texts with labels 0 and 1, or None without both kinds or without words."""
    if not 0 < label.sum() < len(label) or not any(texts):
        return None
    sample = _Sample(texts)
    if not len(sample.codes):
        return None
    row, size = sample.row, sample.size
    head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    tail = np.append(head[1:], len(row))
    rng = np.random.default_rng(seed)
    apart = rng.random(len(texts)) < 0.2
    if len({*label[apart].tolist()}) < 2 or len({*label[~apart].tolist()}) < 2 or len(texts) < 100:
        apart[:] = False
    net = Network(seed)
    odds = _log_odds(sample.words_of, label, ~apart, WORD_BITS)
    net.p["words"][:, 0] = odds / 3
    net.p["chars"][:, 0] = _log_odds(sample.chars_of, label, ~apart, CHAR_BITS) / 3
    sample.words_of = sample.chars_of = None
    high = np.concatenate([[0], np.cumsum(np.maximum(odds[sample.codes], 0) ** 2)])
    logit = (high[sample.at + size] - high[sample.at]).astype(np.float32)
    fit = [(a, b, r) for a, b, r in zip(head.tolist(), tail.tolist(), row[head].tolist()) if not apart[r]]
    adam, balance = _Adam(net.p), float(np.sqrt((1 - label).sum() / label.sum()))
    for epoch in range(epochs):
        if epoch:
            logit = sample.logits(net)
        picks = np.array([a + int(np.argmax(logit[a:b])) for a, b, _ in fit] + [int(rng.integers(a, b)) for a, b, r in fit if not label[r]], np.int64)
        for _ in range(passes):
            for some in np.array_split(rng.permutation(picks), max(1, len(picks) // batch)):
                codes, chars, begin, at, n = sample.gathered(some)
                inputs = net.word_inputs(codes, chars, begin)
                got, cache = net.run(net.project(inputs), at, n, keep=True)
                y = label[row[some]].astype(np.float32)
                slope = ((_sigmoid(got) - y) * np.where(y == 1, balance, 1) / len(some)).astype(np.float32)
                adam.step(net.p, net.back(codes, chars, begin, inputs, cache, slope))
    logit = sample.logits(net)
    judged = [(a, b, r) for a, b, r in zip(head.tolist(), tail.tolist(), row[head].tolist()) if apart[r] or not apart.any()]
    scores = np.array([logit[a:b].max() for a, b, _ in judged])
    # the cut with the most right judgements, midway between neighbours
    by = np.argsort(-scores, kind="stable")
    right = np.concatenate([[0], np.cumsum(np.where(label[[r for _, _, r in judged]][by] == 1, 1, -1))])
    k = int(np.argmax(right))
    ordered = scores[by]
    cut = ordered[0] + 1 if k == 0 else ordered[-1] - 1 if k == len(by) else (ordered[k - 1] + ordered[k]) / 2
    net.p["ob"] -= np.float32(cut)
    return net


def in_training(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = 1200, max_clean: int = 2400, max_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[Network | None, float]:
    """(network, share of toxic labels) from the labelled texts whose id is for training.

    The sample is bounded: at most max_toxic and max_clean ids, twice as many texts (ids may repeat), and max_bytes in all. Texts of more than a 64th of that
    are no part of it, however they are labelled; of the others, in the order of a hash, as many whole ones as fit. Equal texts of an id count once. The cut is made on sizes and digests, and
    only what is left of the texts is brought together.
    """
    wanted = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isin(0, 1) & in_training("id")).withColumn("order", F.xxhash64("id"))
    chosen = None
    for value, most in ((1, max_toxic), (0, max_clean)):
        part = wanted.where(F.col("label") == value).orderBy("order", "id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    labelled = texts.where(F.octet_length("text") <= max_bytes // 64).join(F.broadcast(chosen), "id").withColumn("digest", F.sha2("text", 256))
    some = stored(labelled.select("order", "id", "digest", "label", F.octet_length("text").alias("size"), "text"), "labelled")
    each = some.groupBy("order", "id", "digest", "label").agg(F.first("size").alias("size")).orderBy("order", "id", "digest", "label").limit(2 * (max_toxic + max_clean))
    so_far = F.sum("size").over(Window.orderBy("order", "id", "digest", "label").rowsBetween(Window.unboundedPreceding, 0))
    fits = each.withColumn("so_far", so_far).where(F.col("so_far") <= max_bytes).select("id", "digest", "label")
    sample = some.join(F.broadcast(fits), ["id", "digest", "label"]).dropDuplicates(["id", "digest", "label"]).orderBy("order", "id", "digest", "label").select("text", "label").toPandas()
    label = sample["label"].to_numpy(np.int64)
    return train(sample["text"].tolist(), label), float(label.mean()) if len(label) else 0.0


SCORED = "doc_id long, score double"


def score(docs: DataFrame, network: Network | None, share: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    if network is None:
        return rows.select("doc_id", F.lit(share).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            logits = [shared.value.score(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in slices(offsets)]
            values = _sigmoid(np.concatenate([np.zeros(0, np.float32), *logits]).astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.float64())], names=["doc_id", "score"])

    return rows.mapInArrow(run, SCORED)


def clean(docs: DataFrame, network: Network | None, share: float, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs with a score under the threshold, with all their columns; each is judged where it is read.

    Without a network there is nothing to judge by, so all rows stay, whatever the share of toxic labels. A null or empty text has the score of an
    empty window; a very long one is scored in all its windows; extra columns come through as they are, whatever their names.
    """
    if network is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("doc")
            data, offsets = text_bytes(rows.field(text_col).fill_null(""))
            logits = [shared.value.score(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in slices(offsets)]
            scores = _sigmoid(np.concatenate([np.zeros(0, np.float32), *logits]).astype(np.float64))
            yield batch.filter(pa.array(scores < threshold))

    whole = docs.select(F.struct("*").alias("doc"))
    return whole.mapInArrow(run, whole.schema).select("doc.*")


def judge(docs: DataFrame, labels: DataFrame, **sample) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, by a network trained on the labels."""
    network, share = fit(docs, labels, **sample)
    return score(docs, network, share).select("doc_id", F.coalesce(~in_training(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
