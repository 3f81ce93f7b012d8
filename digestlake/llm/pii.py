"""Personal data by candidate gradient boosting, in DataFrame and SQL functions only.

Base kinds are exact: a pattern and a check each, leftmost matches without overlap. Beside them, high-recall
generators propose overlapping candidate spans: unchecked base matches, and groups of digits between any marks, dotted groups and spelt-out addresses
that the base patterns miss. A candidate is described by its format (groups of digits, letters, separators) and its
context (neighbouring characters, cue words before it).

Each kind has boosted trees of depth two of its own. Their labels are the base spans: a candidate that covers a checked span of the kind is one, all
others are look-alikes, but for those that only touch a span, which are left out. So that a way of writing is not taken for a look-alike because
the base patterns never match it, every base span also counts in a few other ways of writing, in its own context. What decides the base kind is no feature of its trees (the plus and the length of a phone number, the
length and check sum of a card, the mark of an address), so they learn what such data look like otherwise. Look-alikes that are personal data count against the
trees, so precision is judged too low rather than too high. Margins are calibrated by a logistic fit on texts kept out of training, and a kind's
threshold is the margin whose calibrated probability is the wanted one. Selected are candidates above it that overlap no base span and no
better candidate, and that can be of the kind at all (parts of an address up to 255, a card's check sum, 8 to 15 digits of a phone number).

Features are binned and training reads counts of distinct descriptions, of which the max_cells commonest are taken in either fold: a bounded sample
of the labelled rows. The trees are a SQL expression. Texts are read once: candidates are stored with the few characters around them, and described, counted and scored
from there.

Positions come from the texts between matches: split() and regexp_extract_all() walk the same matches, and the running
sum of their lengths gives the code points before each. Patterns are anchored at the start of their run and use
possessive loops, so that long runs take linear time.

Defined results: a null text is the empty text; null doc_ids and repeated rows are treated like others; without
candidates of both labels a kind adds nothing; very long texts are read whole; an empty table gives no rows. Extra columns are ignored, whatever
their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

# The base kinds in the order in which they are listed, as patterns of Java's regex.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?:(?<![0-9])|\G)[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
IS_IP = rf"^{OCTET}(?:\.{OCTET}){{3}}$"
#: Code points of the shortest span that a pattern proposes.
LEAST = {"email": 5, "ip": 7, "card": 13, "phone": 9, "number": 13, "groups": 7, "dotted": 7, "spelt": 7}
#: Generators beyond the base patterns.
MORE = {
    "number": r"(?<![0-9])[0-9]{13,19}(?![0-9])",
    "groups": r"(?<![0-9A-Za-z])\+?[^0-9A-Za-z\s]{0,2}[0-9]{1,6}(?:[^0-9A-Za-z\n]{1,5}[0-9]{1,6}){1,5}(?![0-9A-Za-z])",
    "dotted": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\x20?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)|[.:,!|]{1,3})\x20?[0-9]{1,3}){3}(?![0-9A-Za-z])",
    "spelt": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}+){1,4}",
}
CUES = r"(?:tel|phone|call|fax|mobile|mail|contact|card|visa|iban|ssn|addr|ip)[^A-Za-z]{0,12}$"
FEATURES = ("digits", "letters", "groups", "first", "last", "longest", "dots", "gaps", "paren", "odd", "plus", "at", "before", "after", "cue")
#: What decides the base kind and so is no feature of its trees.
DECIDES = {"email": ("at",), "ip": ("digits",), "card": ("digits", "longest"), "phone": ("digits", "plus")}


def _digits_only(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _luhn(d: str) -> str:
    """SQL: the digits d pass the Luhn check."""
    digit = f"cast(substr({d}, -i, 1) as int)"
    value = f"if(i % 2 = 1, {digit}, {digit} * 2 - if({digit} > 4, 9, 0))"
    return f"aggregate(transform(sequence(1, length({d})), i -> {value}), 0, (s, v) -> s + v) % 10 = 0"


def _between(d: str, least: int, most: int, then: str) -> str:
    return f"case when length({d}) between {least} and {most} then {then} else false end"


CHECKS = {
    "email": lambda x: "true",
    "ip": lambda x: f"{x} rlike r'{IS_IP}'",
    "card": lambda x: f"transform(array({_digits_only(x)}), d -> {_between('d', 16, 19, _luhn('d'))})[0]",
    "phone": lambda x: f"length({_digits_only(x)}) between 8 and 15",
}
SPAN = "array<struct<start:bigint,end:bigint,ok:boolean>>"


#: Matches that are walked at once, so that lists stay short while they grow.
STEP = 256


def _matches(pattern: str, check: str, gate: str, least: int = 1) -> str:
    """SQL: all matches of least code points or more in text as (start, end, ok), in code points; texts that fail the gate are not searched."""
    one = "named_struct('start', a.pos + v.gap, 'end', a.pos + v.gap + v.size, 'ok', v.ok)"
    step = f"named_struct('pos', a.pos + v.gap + v.size, 'out', if(v.size >= {least}, concat(a.out, array({one})), a.out))"
    pairs = f"zip_with(m, slice(split(text, r'{pattern}', -1), 1, size(m)), (x, s) -> named_struct('gap', cast(length(s) as bigint), 'size', cast(length(x) as bigint), 'ok', {check}))"
    inner = f"aggregate(slice(p, k * {STEP} + 1, {STEP}), named_struct('pos', w.pos, 'out', cast(array() as {SPAN})), (a, v) -> {step})"
    outer = f"aggregate(sequence(0, (size(p) - 1) div {STEP}), named_struct('pos', 0L, 'out', cast(array() as array<{SPAN}>)), (w, k) -> transform(array({inner}), z -> named_struct('pos', z.pos, 'out', concat(w.out, array(z.out))))[0], w -> flatten(w.out))"
    walk = f"transform(array({pairs}), p -> {outer})[0]"
    found = f"transform(array(regexp_extract_all(text, r'{pattern}', 0)), m -> if(size(m) = 0, cast(array() as {SPAN}), {walk}))[0]"
    return f"case when {gate} then {found} else cast(array() as {SPAN}) end"


#: Code points of a stretch of a text in which spans meet: a span is listed in each that it reaches into, so no span is held against all others of its text.
STRETCH = 64
#: Code points of the pieces that a long text is cut into to be read from.
CHUNK = 4096


def _met(rows: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    return rows.withColumn("stretch", F.explode(F.expr(f"sequence({start} div {STRETCH}, greatest({end} - 1, {start}) div {STRETCH})")))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two stored tables: (row, doc_id, held, email, ip, card, phone), the base spans of every row; and (row, held, start, end, body, lead, next, kinds, base, free), its candidates.

    A candidate comes with what is read of the text around it. kinds are bits of the kinds whose base spans it covers to three quarters, base of those of which it is one, and free says that it touches none.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("numeric", F.col("text").rlike("[0-9]"))
    patterns = {"email": (EMAIL, "instr(text, '@') > 0"), "ip": (IP, "numeric and instr(text, '.') > 0"), "card": (CARD, "numeric"), "phone": (PHONE, "numeric and instr(text, '+') > 0")}
    spelt = "instr(text, '@') > 0 or contains(lower(text), '(at)') or contains(lower(text), '[at]')"
    gates = {"number": "numeric", "groups": "numeric", "dotted": "numeric", "spelt": spelt}
    found = rows.selectExpr(
        "doc_id", "text", "pmod(xxhash64(text), 5) = 0 as held",
        *[f"{_matches(p, CHECKS[kind]('x'), gate, LEAST[kind])} as all_{kind}" for kind, (p, gate) in patterns.items()],
        *[f"{_matches(MORE[name], 'true', gate, LEAST[name])} as more_{name}" for name, gate in gates.items()],
    )
    every = f"concat({', '.join([*(f'all_{kind}' for kind in KINDS), *(f'more_{name}' for name in MORE)])})"
    # as numbers, among which equal ones are found by hashing
    places = f"transform(array_distinct(transform({every}, c -> c.start * {1 << 31} + c.end)), c -> named_struct('start', c div {1 << 31}, 'end', c % {1 << 31}))"
    # a text is cut into chunks once, so that reading around a span does not walk all that stands before it
    whole = lambda start, size: f"substr(text, cast({start} as int) + 1, cast({size} as int))"
    near = lambda start, size: f"substr(concat(t.ch[cast(({start}) div {CHUNK} as int)], coalesce(get(t.ch, cast(({start}) div {CHUNK} as int) + 1), '')), cast(({start}) % {CHUNK} as int) + 1, cast({size} as int))"
    part = lambda start, size: f"if({size} <= 0, '', if({size} > {CHUNK} or size(t.ch) = 1, {whole(start, size)}, {near(start, size)}))"
    read = f"named_struct('start', c.start, 'end', c.end, 'body', {part('c.start', 'c.end - c.start')}, 'lead', {part('greatest(c.start - 24, 0)', 'least(c.start, 24)')}, 'next', {part('c.end', 'least(t.n - c.end, 1)')})"
    out = found.selectExpr("doc_id", "held", *[f"filter(all_{kind}, c -> c.ok) as {kind}" for kind in KINDS], f"transform(array(named_struct('n', length(text), 'ch', if(length(text) <= {CHUNK}, array(text), regexp_extract_all(text, '(?s).{{1,{CHUNK}}}+', 0)))), t -> transform({places}, c -> {read}))[0] as cands")
    found = stored(out.withColumn("row", F.monotonically_increasing_id()), "pii")
    each = found.select("row", "held", F.explode("cands").alias("s")).select("row", "held", "s.*")
    spans = found.selectExpr("row", f"explode(concat({', '.join(f'transform({kind}, b -> named_struct("bit", {1 << i}, "b_start", b.start, "b_end", b.end))' for i, kind in enumerate(KINDS))})) as b").select("row", "b.*")
    touch = _met(each.select("row", "start", "end")).join(_met(spans, "b_start", "b_end"), ["row", "stretch"]).where("b_start < end and start < b_end")
    covers = "if(4 * (least(b_end, end) - greatest(b_start, start)) >= 3 * (b_end - b_start), bit, 0)"
    facts = touch.groupBy("row", "start", "end").agg(F.expr(f"bit_or({covers})").alias("kinds"), F.expr("bit_or(if(b_start = start and b_end = end, bit, 0))").alias("base"))
    whole = each.join(facts, ["row", "start", "end"], "left").selectExpr("row", "held", "start", "end", "body", "lead", "next", "coalesce(kinds, 0) as kinds", "coalesce(base, 0) as base", "kinds is null as free")
    return found.drop("cands"), stored(whole, "candidates")


#: SQL: the candidate has the mark of an address.
AT = r"b rlike r'@|[(\[]at[)\]]'"
#: How a base span (x) may be written otherwise, as the generators would propose it: what trees learn from beside the span itself.
WRITTEN = {
    "email": ["replace(x, '@', ' (at) ')", "replace(replace(x, '@', '[at]'), '.', '[dot]')", "replace(replace(x, '@', ' [at] '), '.', ' (dot) ')"],
    "ip": ["replace(x, '.', '[.]')", "replace(x, '.', '(.)')", "replace(x, '.', ' . ')"],
    "card": [f"substr(regexp_replace(regexp_replace(x, '[^0-9]', ''), '([0-9]{{4}})', '{mark}$1'), 2)" for mark in (" ", "-", ".")],
    "phone": [r"regexp_replace(x, r'^[+][0-9]{1,3}[ .-]*(?=[(0-9])', '')", "substr(regexp_replace(x, '[^0-9]+', '-'), 2)", "substr(regexp_replace(x, '[^0-9]+', '.'), 2)", "replace(x, ' ', '!! ')", "replace(x, ' ', ' | ')", "regexp_replace(x, '[^0-9+]+', '/')"],
}


def described(cands: DataFrame) -> DataFrame:
    """(row, held, start, end, made, free, kinds, may, c) of every candidate: c has its features, kinds and may are bits.

    kinds are those of the base spans that it covers, free that it touches none, may what it can be at all. A candidate that is a base
    span comes again in other ways of writing, with made, for training alone.
    """
    bits = lambda tests: " + ".join(f"if({test}, {1 << i}, 0)" for i, test in enumerate(tests))
    no = "cast(array() as array<string>)"
    others = ", ".join(f"if((base & {1 << i}) <> 0, transform(array(body), x -> array({', '.join(WRITTEN[k])}))[0], {no})" for i, k in enumerate(KINDS))
    one = cands.selectExpr("row", "held", "start", "end", "lead", "next", "kinds", "free", f"concat(array(body), {others}) as bodies")
    one = one.selectExpr("*", "posexplode(bodies) as (nth, b)").selectExpr("*", f"{_digits_only('b')} as d", "filter(split(b, '[^0-9]+'), g -> g <> '') as parts")
    side = lambda c: f"case when {c} = '' or {c} rlike '^[\\s]' then 0 when {c} rlike '^[A-Za-z0-9]' then 2 else 1 end"
    fields = {
        "digits": "least(length(d) div 2, 10)",
        "letters": "least(length(regexp_replace(b, '[^A-Za-z]', '')), 3)",
        "groups": "least(size(parts), 6)",
        "first": "least(coalesce(length(try_element_at(parts, 1)), 0), 6)",
        "last": "least(coalesce(length(try_element_at(parts, -1)), 0), 6)",
        "longest": "least(coalesce(array_max(transform(parts, g -> length(g))), 0), 8)",
        "dots": "least(length(regexp_replace(b, '[^.]', '')), 4)",
        "gaps": "least(length(regexp_replace(b, '[^ -]', '')), 5)",
        "paren": "cast(b rlike '[()]' as int)",
        "odd": "cast(b rlike '[^0-9A-Za-z ().@+-]' as int)",
        "plus": "cast(startswith(b, '+') as int)",
        "at": f"cast({AT} as int)",
        "before": side("substr(lead, -1, 1)"),
        "after": side("next"),
        "cue": f"cast(lower(lead) rlike r'{CUES}' as int)",
    }
    able = {
        "email": rf"{AT} and b rlike r'[A-Za-z0-9][ ]?([.]|[(\[]dot[)\]])'",
        "ip": "size(parts) = 4 and not exists(parts, g -> length(g) > 3 or cast(g as int) > 255) and not b rlike '[A-Za-ce-np-su-z]'",
        "card": f"not b rlike '[A-Za-z+]' and {_between('d', 13, 19, _luhn('d'))}",
        "phone": "not b rlike '[A-Za-z]' and length(d) between 8 and 15",
    }
    features = ", ".join(f"'{name}', {fields[name]}" for name in FEATURES)
    return one.selectExpr("row", "held", "start", "end", "nth > 0 as made", "free and nth = 0 as free", "kinds", f"{bits(able[k] for k in KINDS)} as may", f"named_struct({features}) as c")


def _best_split(cells: list, residual: list[float], weight: list[float], members: list[int], features: list[int]):
    """(gain, feature, cut) of the split of members by one of features with the least squared error, or None."""
    total_w, total_r = sum(weight[i] for i in members), sum(residual[i] * weight[i] for i in members)
    best = None
    for f in features:
        sums: dict[int, list[float]] = {}
        for i in members:
            s = sums.setdefault(cells[i][f], [0.0, 0.0])
            s[0] += weight[i]
            s[1] += residual[i] * weight[i]
        w = r = 0.0
        for cut in sorted(sums)[:-1]:
            w += sums[cut][0]
            r += sums[cut][1]
            gain = r * r / (w + 1) + (total_r - r) ** 2 / (total_w - w + 1) - total_r**2 / (total_w + 1)
            if best is None or gain > best[0] + 1e-12:
                best = (gain, f, cut)
    return best


def boost(cells: list[tuple[int, ...]], positive: list[int], count: list[int], rounds: int = 30, rate: float = 0.3, without: tuple[str, ...] = ()):
    """(prior, trees): a tree is a number, or (feature, cut, tree if feature <= cut, tree otherwise)."""
    features = [f for f, name in enumerate(FEATURES) if name not in without]
    weight = [float(n) for n in count]
    rate_of = [p / n for p, n in zip(positive, count)]
    share = min(max(sum(positive) / max(1, sum(count)), 1e-3), 1 - 1e-3)
    prior = math.log(share / (1 - share))
    margin, trees = [prior] * len(cells), []
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        residual = [y - q for y, q in zip(rate_of, p)]

        def grow(members: list[int], depth: int):
            split = _best_split(cells, residual, weight, members, features) if depth else None
            if split is None or split[0] <= 1e-9:
                top = sum(residual[i] * weight[i] for i in members)
                return rate * top / (sum(weight[i] * p[i] * (1 - p[i]) for i in members) + 1)
            _, f, cut = split
            return (f, cut, grow([i for i in members if cells[i][f] <= cut], depth - 1), grow([i for i in members if cells[i][f] > cut], depth - 1))

        tree = grow(list(range(len(cells))), 2)
        trees.append(tree)
        margin = [m + evaluate(tree, c) for m, c in zip(margin, cells)]
    return prior, trees


def evaluate(tree, cell: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if cell[tree[0]] <= tree[1] else tree[3]
    return tree


def tree_sql(tree, row: str) -> str:
    if not isinstance(tree, tuple):
        return f"{tree!r}D"
    return f"if({row}.{FEATURES[tree[0]]} <= {tree[1]}, {tree_sql(tree[2], row)}, {tree_sql(tree[3], row)})"


def calibrated(margins: list[float], positive: list[int], count: list[int], rounds: int = 50) -> tuple[float, float]:
    """(a, b) of the probability 1 / (1 + exp(-(a * margin + b))) by Platt's fit, whose targets are kept off 0 and 1 by the number of examples."""
    n1 = sum(positive)
    n0 = sum(count) - n1
    high, low = (n1 + 1) / (n1 + 2), 1 / (n0 + 2)
    target = [(p * high + (n - p) * low) / n for p, n in zip(positive, count)]
    a, b = 1.0, 0.0
    for _ in range(rounds):
        g_a = g_b = 0.0
        h_aa, h_ab, h_bb = 1e-6, 0.0, 1e-6
        for m, t, n in zip(margins, target, count):
            q = 1 / (1 + math.exp(-max(-30.0, min(30.0, a * m + b))))
            w = n * max(q * (1 - q), 1e-9)
            g_a, g_b = g_a + n * (q - t) * m, g_b + n * (q - t)
            h_aa, h_ab, h_bb = h_aa + w * m * m, h_ab + w * m, h_bb + w
        det = h_aa * h_bb - h_ab * h_ab
        step_a, step_b = (h_bb * g_a - h_ab * g_b) / det, (h_aa * g_b - h_ab * g_a) / det
        size = max(abs(step_a), abs(step_b), 1.0)
        a, b = a - step_a / size, b - step_b / size
        if abs(step_a) + abs(step_b) < 1e-9:
            break
    return a, b


def train(cands: DataFrame, precision: float = 0.75, max_cells: int = 4000) -> dict[str, tuple]:
    """For each kind (prior, trees, threshold on the margin), where both folds have candidates that are of the kind and others and a threshold has the precision.

    Only counts of distinct descriptions reach the driver: the max_cells commonest of either fold.
    """
    names = list(FEATURES)
    one = described(cands).where("free or kinds <> 0").select("held", *[F.col(f"c.{n}").alias(n) for n in names], *[F.expr(f"kinds & {1 << i}").cast("boolean").cast("int").alias(f"is_{kind}") for i, kind in enumerate(KINDS)])
    counts = one.groupBy("held", *names).agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"is_{kind}").alias(kind) for kind in KINDS])
    folds = {held: counts.where(F.col("held") == held).orderBy(F.desc("n"), *names).limit(max_cells).collect() for held in (False, True)}
    cells = {held: [tuple(r[n] for n in names) for r in rows] for held, rows in folds.items()}
    size = {held: [r["n"] for r in rows] for held, rows in folds.items()}
    models = {}
    for kind in KINDS:
        positive = {held: [r[kind] for r in rows] for held, rows in folds.items()}
        if any(not 0 < sum(positive[held]) < sum(size[held]) for held in folds):
            continue
        prior, trees = boost(cells[False], positive[False], size[False], without=DECIDES[kind])
        margins = [prior + sum(evaluate(t, c) for t in trees) for c in cells[True]]
        a, b = calibrated(margins, positive[True], size[True])
        if a > 0:
            models[kind] = prior, trees, (math.log(precision / (1 - precision)) - b) / a
    return models


ADDED = "array<struct<start:bigint,end:bigint,kind:string,score:double>>"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, email, ip, card, phone, added) of every row; added has the candidates that the trees of a kind selected, with their margin above its threshold."""
    found, cands = candidates(docs, id_col, text_col)
    return select(found, cands, train(cands))


def select(found: DataFrame, cands: DataFrame, models: dict[str, tuple]) -> DataFrame:
    """What find gives, by trained models. Only candidates that are selected meet each other, by stretch, and then their row."""
    nothing = f"cast(array() as {ADDED})"
    if not models:
        return found.selectExpr("doc_id", *KINDS, f"{nothing} as added")
    scored = []
    for i, kind in enumerate(KINDS):
        if kind in models:
            prior, trees, threshold = models[kind]
            margin = " + ".join([f"{prior!r}D", *[tree_sql(t, "c") for t in trees]])
            scored.append(f"if((may & {1 << i}) <> 0, named_struct('start', start, 'end', end, 'kind', '{kind}', 'score', {margin} - {threshold!r}D), null)")
    # sums of the same terms in another order may differ in the last digits
    picked = stored(described(cands).where("free and may <> 0").selectExpr("row", f"explode(filter(array({', '.join(scored)}), s -> s.score >= -1e-9D)) as s").distinct(), "picked")
    met = _met(picked.selectExpr("row", "s", "s.start", "s.end")).drop("start", "end")
    better = "o.start < s.end and s.start < o.end and (o.score > s.score or (o.score = s.score and (o.start < s.start or (o.start = s.start and (o.end > s.end or (o.end = s.end and o.kind < s.kind))))))"
    beaten = met.join(met.withColumnRenamed("s", "o"), ["row", "stretch"]).where(better).select("row", "s").distinct()
    added = picked.join(beaten, ["row", "s"], "left_anti").groupBy("row").agg(F.array_sort(F.collect_list("s")).alias("added"))
    return found.join(added, "row", "left").selectExpr("doc_id", *KINDS, f"coalesce(added, {nothing}) as added")
