"""Prompts, manifests, digest documents, spoken scripts and chunks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestlake.functions import patterns as P
from digestlake.functions import text as T

# What a prompt says before its posts.
ASK = "Summarize the key narratives, stories, and sentiment in these tweets.\nInclude specific examples with @handles and tweet IDs for sourcing.\nFocus on: What's happening? Why does it matter? What's the sentiment?\n"
ASK_VIRAL = "These are standalone viral tweets - unique content that resonated but doesn't\nbelong to a trending topic or narrative. Worth including in the digest.\n"


def prompt_row(number: str = "rn") -> Column:
    return F.concat(F.lit("["), F.col(number).cast("string"), F.lit("] @"), F.col("screen_name"), F.lit(" ("), F.format_number("likes", 0), F.lit(" likes)\nID: "), F.col("id"), F.lit("\nText: "), T.one_line("text", 500), F.lit("\n"))


def prompts(rows: DataFrame, group: str, head: Column, ask: str = ASK) -> DataFrame:
    """(group, n, prompt) from rows that are numbered in their group; head is the first line, from the group's columns."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", prompt_row().alias("line")))), lambda s: s["line"]), "\n")
    grouped = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), body.alias("body"))
    return grouped.select(group, "n", F.concat(head, F.lit("\n# Tweet count: "), F.col("n").cast("string"), F.lit("\n\n" + ask + "\n---\n\n"), F.col("body")).alias("prompt"))


# The prompt that joins the summaries of all groups.
SYNTHESIS = """You are synthesizing a Twitter timeline digest.

CORPUS STATS:
- Total tweets: {total}
- Date range: Last 24-48 hours
- Topic distribution: {topics}

CLUSTER SUMMARIES:
{summaries}

---

Create a cohesive digest that:
1. Opens with an Executive Summary (3-4 bullets on the dominant themes)
2. Has sections for each major topic with narrative flow
3. Cites specific tweets with links: https://x.com/USER/status/ID
4. Notes overall sentiment and vibe
5. Highlights the most viral/important tweets

Format as clean Markdown suitable for reading.
"""


def synthesis_prompt(stats: dict, summaries: list[str]) -> str:
    return SYNTHESIS.format(total=stats.get("total_tweets", 0), topics=json.dumps(stats.get("topic_distribution", {}), indent=2), summaries="\n".join(summaries))


def highlights(rows: DataFrame) -> DataFrame:
    """(n, prompt) of numbered posts that stand alone, one row."""
    head = F.lit("# Viral Highlights\n# High-engagement tweets that didn't fit into topic clusters")
    return prompts(rows.withColumn("part", F.lit(0)), "part", head, ASK_VIRAL).select("n", "prompt")


def file_label(cluster: Column, label: Column, hybrid: bool = False) -> Column:
    name = F.substring(F.regexp_replace(F.regexp_replace(label, r"[^\p{L}\p{N}_\s-]", ""), r"\s+", "_"), 1, 40) if hybrid else F.substring(F.replace(F.replace(label, F.lit(" / "), F.lit("_")), F.lit(" "), F.lit("_")), 1, 30)
    return F.concat(F.lit("cluster_"), F.lpad(cluster.cast("string"), 2, "0"), F.lit("_"), name)


def digest_line() -> Column:
    marks = F.concat(F.when(F.col("curated"), F.lit("★ ")).otherwise(F.lit("")), F.when(F.col("verified"), F.lit("✅ ")).otherwise(F.lit("")))
    who = F.concat(F.lit("- "), marks, F.lit("**@"), F.col("screen_name"), F.lit("** ("), F.format_number("likes", 0), F.lit(" likes · "), T.short_count("followers"), F.lit(" followers): "))
    return F.concat(who, T.one_line("text", 220, "..."))


def source_line() -> Column:
    return F.concat(F.lit("  [source](https://x.com/"), F.col("screen_name"), F.lit("/status/"), F.col("id"), F.lit(")"))


def _post_lines(rows: DataFrame, section: int, group: Column) -> DataFrame:
    lines = F.array(digest_line(), source_line(), F.lit(""))
    return rows.select(F.lit(section).alias("section"), group.cast("bigint").alias("part"), F.col("rn").cast("bigint").alias("rank"), F.posexplode(lines).alias("line_no", "line"))


def _fixed(like: DataFrame, section: int, part: Column, rank: int, lines: list) -> DataFrame:
    texts = F.array(*[x if isinstance(x, Column) else F.lit(x) for x in lines])
    return like.select(F.lit(section).alias("section"), part.cast("bigint").alias("part"), F.lit(rank).cast("bigint").alias("rank"), F.posexplode(texts).alias("line_no", "line"))


def digest_lines(posts: DataFrame, stories: DataFrame, sources: DataFrame, others: DataFrame, title: str, stamp: str, span: str = "last 48h") -> DataFrame:
    """(section, part, rank, line_no, line): the lines of the digest, in that order. The parts are limited reports, so the document is small."""
    zero = F.lit(0)
    total = posts.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("screen_name").alias("accounts"), F.count_distinct(F.when(F.col("curated"), F.col("screen_name"))).alias("curated"))
    what = F.concat(F.lit(f"**{stamp} UTC** — "), F.col("n").cast("string"), F.lit(" tweets / "), F.col("accounts").cast("string"), F.lit(" accounts ("), F.col("curated").cast("string"), F.lit(f" curated sources) / {span}"))
    out = [_fixed(total, 0, zero, 0, [f"# {title}", what, ""]), _fixed(total.where("n = 0"), 0, zero, 1, ["*No tweets to report.*"])]
    some = total.where("n > 0").select("n")
    counted = stories.agg(F.count(F.lit(1)).alias("k")).crossJoin(some)
    out.append(_fixed(some, 1, zero, 0, ["---", "", f"## 🔥 Momentum ({span})", "*Accounts = distinct quality accounts (curated / verified / 5k+ followers).*", ""]))
    out.append(_fixed(counted.where("k > 0"), 1, zero, 1, ["| Topic | Tweets | Accounts | Verified | Total likes |", "|---|---|---|---|---|"]))
    row = F.concat_ws(" ", F.lit("|"), "entity", F.lit("|"), F.col("tweets").cast("string"), F.lit("|"), F.col("quality").cast("string"), F.lit("|"), F.col("n_verified").cast("string"), F.lit("|"), F.format_number("likes", 0), F.lit("|"))
    out.append(_fixed(stories, 1, F.col("story"), 2, [row]))
    out.append(_fixed(counted.where("k > 0"), 1, F.lit(1_000_000), 3, [""]))
    out.append(_fixed(counted.where("k = 0"), 1, zero, 1, ["*No topic reached the momentum threshold.*", ""]))
    out.append(_fixed(some, 2, zero, 0, ["---", "", "## 📰 Stories (by momentum; sources trusted-first)", ""]))
    told = stories.join(sources.select("story").distinct(), "story", "left_semi")
    head = F.concat(F.lit("### "), F.col("entity"), F.lit(" — "), F.col("tweets").cast("string"), F.lit(" tweets / "), F.col("quality").cast("string"), F.lit(" accounts / "), F.col("n_verified").cast("string"), F.lit(" verified"))
    out += [_fixed(told, 2, F.col("story"), 0, [head, ""]), _post_lines(sources, 2, F.col("story")), _fixed(told, 2, F.col("story"), 1_000_000, [""])]
    any_other = others.agg(F.count(F.lit(1)).alias("k")).where("k > 0")
    out += [_fixed(any_other, 3, zero, 0, ["---", "", "## Other notable (trusted-first)", ""]), _post_lines(others, 3, F.lit(1))]
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole.select("section", "part", "rank", F.col("line_no").cast("bigint").alias("line_no"), "line")


def document(lines: DataFrame) -> str:
    """The digest as one text; its lines are bounded by the caps of its parts."""
    return "\n".join(r["line"] for r in lines.orderBy("section", "part", "rank", "line_no").collect())


# -- spoken script --------------------------------------------------------------------------------

_M = "(?m)"
# The passes over a document before and after its tables and lists.
BEFORE = [
    (_M + r"^---+\s*$", ""), (_M + r"^#\s+(.+)$", "\n\n$1.\n"), (_M + r"^##\s+(.+)$", "\nNext topic: $1.\n"), (_M + r"^###\s+(.+)$", "\n$1.\n"), (_M + r"^#{4,}\s+(.+)$", "$1."),
    (r"\[([^\]]+)\]\([^)]+\)", "$1"), (r"https?://[^\s\p{Z}]+", ""), (r"\*\*([^*]+)\*\*", "$1"), (r"\*([^*]+)\*", "$1"), (r"__([^_]+)__", "$1"), (r"_([^_]+)_", "$1"),
]
AFTER = [
    (r"```[\s\S]*?```", ""), (r"`([^`]+)`", "$1"), (P.EMOJI[:-2] + r"\x{2600}-\x{26FF}\x{1F004}-\x{1F0CF}]+", ""), (rf"@({P.WORD}+)", "$1"),
    (P.java(r"\bK\b") + r"(?=\s*likes)", "thousand"), (P.java(r"\b(\d+)K\b"), "$1 thousand"), (P.java(r"\b(\d+)M\b"), "$1 million"), (P.java(r"\b(\d+)B\b"), "$1 billion"), (P.java(r"\bGPT-(\d)"), "GPT $1"),
    ("\n{3,}", "\n\n"), (" {2,}", " "), (rf"^{P.BLANK}+|{P.BLANK}+$", ""),
]


def _passes(text: Column, passes: list[tuple[str, str]]) -> Column:
    for pattern, to in passes:
        text = F.regexp_replace(text, pattern, to)
    return text


def spoken_lines(text: Column) -> Column:
    """Tables as lists, bullets and numbers without their marks. Rows of a table count once its separator has passed; a fold over the lines carries that."""
    line = lambda s: F.regexp_replace(s, rf"^{P.BLANK}+|{P.BLANK}+$", "")
    strip = lambda s: F.regexp_replace(s, r"^\s*(?:[-*]|\p{Nd}+\.)\s+", "  ")

    def step(state, raw):
        s = line(raw)
        rule, row = s.rlike(r"^\|[-:\s|]+\|$"), s.startswith("|") & s.endswith("|")
        cells = F.filter(F.transform(F.slice(F.split(s, r"\|"), 2, F.greatest(F.size(F.split(s, r"\|")) - 2, F.lit(0))), line), lambda c: (c != "") & ~c.rlike("^[-:]+$"))
        spoken = F.array_join(cells, ", ")
        said = F.when(rule, F.lit(None)).when(row, F.when(state["table"] & (spoken != ""), F.concat(F.lit("  "), spoken, F.lit(".")))).when(s.rlike(r"^(?:[-*]|\p{Nd}+\.)\s+"), strip(s)).otherwise(raw)
        return F.struct((rule | (row & state["table"])).alias("table"), F.when(said.isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(said))).alias("out"))

    start = F.struct(F.lit(False).alias("table"), F.expr("cast(array() as array<string>)").alias("out"))
    return F.array_join(F.aggregate(F.split(text, "\n"), start, step, lambda s: s["out"]), "\n")


def spoken(text) -> Column:
    """A document as a script to be read aloud."""
    body = _passes(spoken_lines(_passes(T._t(text), BEFORE)), AFTER)
    return F.concat(F.lit("Here's your timeline briefing.\n\n"), body, F.lit("\n\nThat's your briefing for today."))


# -- chunks ---------------------------------------------------------------------------------------


def fixed_chunks(docs: DataFrame, key: str, text: str, size: int = 3500) -> DataFrame:
    """(key, n, of, chunk): the text in pieces of size characters, marked (n/of); an empty text has none."""
    n = F.ceil(F.length(text) / F.lit(size)).cast("int")
    rows = docs.where(F.length(text) > 0).select(key, F.col(text).alias("_t"), n.alias("of")).select(key, "_t", "of", F.explode(F.sequence(F.lit(1), F.col("of"))).alias("n"))
    piece = F.substring(F.col("_t"), (F.col("n") - 1) * size + 1, F.lit(size))
    return rows.select(key, F.col("n").cast("bigint").alias("n"), F.col("of").cast("bigint").alias("of"), F.concat(F.lit("("), F.col("n").cast("string"), F.lit("/"), F.col("of").cast("string"), F.lit(") "), piece).alias("chunk"))


#: Characters of a batch of chunks.
CHUNK_CHARACTERS = 1 << 20


def joined_blocks(blocks: list[str], most: int) -> list[list[str]]:
    """Blocks in order, as many to a batch as most characters allow, the blank line after each counted in; a longer block is a batch of its own."""
    out: list[list[str]] = []
    used = 0
    for block in blocks:
        need = len(block) + 2
        if out and used + need <= most:
            out[-1].append(block)
            used += need
        else:
            out.append([block])
            used = need
    return out


def sentence_chunks(text: str, most: int = 4000) -> list[str]:
    """Paragraphs packed into chunks of most characters; a longer paragraph is packed by sentences."""
    if len(text) <= most:
        return [text]
    units = []
    for paragraph in text.split("\n\n"):
        units += [(s, " ") for s in re.split(r"(?<=[.!?])\s+", paragraph)] if len(paragraph) > most else [(paragraph, "\n\n")]
    out, held = [], ""
    for unit, joint in units:
        if len(held) + len(unit) + len(joint) > most:
            out += [held.strip()] if held else []
            held = unit
        else:
            held = held + joint + unit if held else unit
    return out + ([held.strip()] if held.strip() else [])


def chunked(docs: DataFrame, key: str, text: str, most: int = 4000, by_sentence: bool = True) -> DataFrame:
    """(key, n, chunk) by sentence_chunks or by joined_blocks. Texts leave their Arrow batch one by one, and chunks go on in batches of CHUNK_CHARACTERS, so memory does not grow with a batch's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def out() -> pa.RecordBatch:
            k, n, chunk = zip(*rows)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(k, pa.string()), pa.array(n, pa.int64()), pa.array(chunk, pa.string())], names=["k", "n", "chunk"])

        for batch in batches:
            for k, t in zip(batch.column("k"), batch.column("t")):
                k, t = k.as_py(), t.as_py() or ""
                parts = sentence_chunks(t, most) if by_sentence else ["\n\n".join(b) for b in joined_blocks(t.split("\n\n"), most)]
                for i, part in enumerate(parts, 1):
                    rows.append((k, i, part))
                    size += len(part)
                    if size >= CHUNK_CHARACTERS:
                        yield out()
                        size = 0
        if rows:
            yield out()

    return docs.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).mapInArrow(run, "k string, n long, chunk string").withColumnRenamed("k", key)
