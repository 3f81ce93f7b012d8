"""Column functions over post texts. All of them stay inside the JVM; nulls give what an empty text gives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _t(x) -> Column:
    return F.coalesce(_c(x), F.lit(""))


def literal_map(d: dict) -> Column:
    return F.create_map(*[F.lit(v) for kv in d.items() for v in kv])


def hashtags(text) -> Column:
    return F.regexp_extract_all(F.lower(_t(text)), F.lit(f"#({P.WORD}+)"), 1)


def raw_hashtags(text) -> Column:
    return F.regexp_extract_all(_t(text), F.lit(f"#({P.WORD}+)"), 1)


def mentions(text) -> Column:
    return F.regexp_extract_all(F.lower(_t(text)), F.lit(f"@({P.WORD}+)"), 1)


def urls(text) -> Column:
    return F.regexp_extract_all(_t(text), F.lit(r"https?://[^\s\p{Z}]+"), 0)


def cashtags(text) -> Column:
    return F.regexp_extract_all(_t(text), F.lit(r"\$([A-Z]{2,5})"), 1)


def tokens(text) -> Column:
    """The text between white space."""
    return F.filter(F.split(_t(text), f"{P.BLANK}+"), lambda w: w != "")


def with_words(text, patterns: list[str], body, lowered: Column | None = None) -> Column:
    """body(s) over a struct of the text, its lower-cased form and those of its words that the patterns need, each of which is computed once for the row.

    The two letters that regular expressions hold for s and i become those, so that words are found where a search that ignores case finds them.
    """
    swap = lambda t, a, b: F.replace(t, F.lit(a), F.lit(b))
    low = swap(swap(F.lower(swap(_t(text), "İ", "i")) if lowered is None else lowered, "ſ", "s"), "ı", "i")
    asked = sorted({w for p in patterns for words, _, _ in P.needs(p) or [] for w in words})
    known = lambda s: F.array_intersect(F.split(s["low"], f"{P.NOT_WORD}+"), F.array(*map(F.lit, asked)))
    bind = lambda s: F.struct(s["text"].alias("text"), s["low"].alias("low"), known(s).alias("known"))
    return F.transform(F.transform(F.array(F.struct(_t(text).alias("text"), low.alias("low"))), bind), body)[0]


def occurs(s: Column, patterns: list[str]) -> Column:
    """Whether any of the patterns occurs in a struct of with_words. Single words are looked up, and expressions are searched only where the words that they need are there."""
    either, all_of = lambda a, b: a | b, lambda a, b: a & b
    alone, out = [], []
    for pattern in patterns:
        search, forms, maybe = s["text"].rlike(P.any_java([pattern])), P.needs(pattern), []
        for words, parts, exact in forms or []:
            if exact:
                alone += words
            else:
                maybe.append(reduce(all_of, [F.array_contains(s["known"], w) for w in words] + [F.contains(s["low"], F.lit(part)) for part in parts]))
        if maybe or forms is None:
            out.append(reduce(either, maybe) & search if maybe else search)
    single = [F.arrays_overlap(s["known"], F.array(*map(F.lit, alone)))] if alone else []
    return reduce(either, single + out)


def hits(s: Column, patterns: list[str]) -> Column:
    """How many of the patterns occur in a struct of with_words, each counted once."""
    return reduce(lambda a, b: a + b, [occurs(s, [p]).cast("int") for p in patterns])


def topics(text) -> Column:
    """The topics of text, account and hashtag signals in the order of the catalogue, or general.

    A hashtag begins and ends at boundaries of the text, so what its name matches is found in the text.
    """
    low = F.lower(_t(text))
    named = F.array_compact(F.transform(mentions(text), lambda m: F.try_element_at(literal_map(P.ACCOUNT_TOPICS), m)))

    def found(s: Column) -> Column:
        by_words = F.array_compact(F.array(*[F.when(occurs(s, patterns), F.lit(topic)) for topic, patterns in P.TOPICS.items()]))
        every = F.transform(F.array(F.concat(by_words, named)), lambda a: F.filter(F.array(*map(F.lit, P.TOPICS)), lambda t: F.array_contains(a, t)))
        return every[0]

    every = [p for patterns in P.TOPICS.values() for p in patterns]
    listed = F.transform(F.array(with_words(text, every, found, low)), lambda a: F.when(F.size(a) > 0, a).otherwise(F.array(F.lit("general"))))
    return listed[0]


def force_topics(found: Column, forced: list[str]) -> Column:
    """general goes; each forced topic that is missing comes first, the later ones before the earlier."""
    out = F.array_remove(found, "general") if forced else found
    for topic in forced:
        out = F.when(F.array_contains(out, topic), out).otherwise(F.concat(F.array(F.lit(topic)), out))
    return out


def named(text, names: list[str]) -> Column:
    return with_words(text, [P.exactly(n) for n in names], lambda s: F.array_compact(F.array(*[F.when(occurs(s, [P.exactly(n)]), F.lit(n)) for n in names])))


def tier(likes) -> Column:
    n = F.coalesce(_c(likes), F.lit(0))
    return F.when(n >= 50000, "viral").when(n >= 10000, "high").when(n >= 1000, "medium").otherwise("low")


def tier_rank(likes) -> Column:
    n = F.coalesce(_c(likes), F.lit(0))
    return F.when(n >= 50000, 0).when(n >= 10000, 1).when(n >= 1000, 2).otherwise(3)


def content_type(text, is_retweet, is_quote) -> Column:
    no = F.lit(False)
    return F.when(F.coalesce(_c(is_retweet), no), "retweet").when(F.coalesce(_c(is_quote), no), "quote").when(_t(text).startswith("@"), "reply").otherwise("original")


def views(x) -> Column:
    return F.coalesce(F.when(_c(x).rlike("^[0-9]+$"), _c(x).try_cast("bigint")), F.lit(0).cast("bigint"))


def parsed_time(created_at) -> Column:
    """The time without regard to the weekday, or null if malformed."""
    return F.try_to_timestamp(F.substring(_c(created_at), 5, 64), F.lit("MMM dd HH:mm:ss Z yyyy"))


#: What clean replaces, by a part that a text then has. Removals end at white space, so that no part comes to be by one.
_CLEANED = (
    ("http", r"https?://[^\s\p{Z}]+", ""), ("t.co/", r"t\.co/[^\s\p{Z}]+", ""), ("RT", rf"^RT{P.BLANK}+", ""), ("via", rf"(?<!{P.WORD})via{P.BLANK}+@{P.WORD}+", ""),
    ("@", rf"@{P.WORD}+", "@USER"), ("#", rf"#({P.WORD}+)", "$1"),
)
#: White space other than single spaces.
_WIDE = rf"(?: (?={P.BLANK})|[\s\p{{Z}}&&[^ ]]){P.BLANK}*"


def clean(text) -> Column:
    """The text without links, marks of tags and retweets. An expression is searched only where the part that it needs is there."""
    t = _t(text)
    out = t
    for part, pattern, to in _CLEANED:
        out = F.transform(F.array(out), lambda x: F.when(F.contains(t, F.lit(part)), F.regexp_replace(x, pattern, to)).otherwise(x))[0]
    return F.trim(F.regexp_replace(out, _WIDE, " "))


def _proper(text) -> Column:
    """The word characters of what stands between white space, where the first of them is a capital."""
    found = F.regexp_extract_all(_t(text), F.lit(r"(?<![^\s\p{Z}])[^\p{L}\p{N}_\s\p{Z}]*\p{Lu}[^\s\p{Z}]*"), 0)
    return F.transform(found, lambda w: F.regexp_replace(w, P.NOT_WORD, ""))


def news_entities(text) -> Column:
    names = F.filter(_proper(text), lambda w: (F.length(w) > 2) & ~F.lower(w).isin(P.NOT_NEWS))
    return F.concat(names, raw_hashtags(text))


def capital_entities(text) -> Column:
    names = F.filter(_proper(text), lambda w: (F.length(w) > 1) & ~w.isin(P.NOT_ENTITIES))
    return F.array_distinct(F.concat(names, raw_hashtags(text), cashtags(text)))


def canonical_entities(text) -> Column:
    """Tickers, hashtags, known words, known substrings in other scripts and proper words, by their common names."""
    known = literal_map(P.SYNONYMS)
    look = lambda w, other: F.coalesce(F.try_element_at(known, F.lower(w)), other)
    t = _t(text)
    tickers = F.transform(F.regexp_extract_all(t, F.lit(rf"\$[A-Za-z]{{2,6}}(?!{P.WORD})"), 0), lambda w: look(w, F.upper(w)))
    tags = F.transform(raw_hashtags(t), lambda w: look(w, F.concat(F.lit("#"), w)))
    words = F.transform(F.regexp_extract_all(F.lower(t), F.lit("[a-z0-9]{2,}"), 0), lambda w: F.try_element_at(known, w))
    other = F.array(*[F.when(F.contains(t, F.lit(w)), F.lit(P.SYNONYMS[w])) for w in P.SYNONYMS if not w.isascii()])
    proper = F.transform(F.regexp_extract_all(t, F.lit("[A-Z][A-Za-z]{2,}"), 0), lambda w: look(w, F.when(~w.isin(P.NOT_PROPER), w)))
    return F.array_distinct(F.array_compact(F.concat(tickers, tags, words, other, proper)))


def label_words(text, stop: list[str] = P.STOP_WORDS) -> Column:
    return F.filter(F.transform(tokens(F.lower(_t(text))), trimmed), lambda w: labels(w, stop))


def trimmed(token) -> Column:
    return F.btrim(token, F.lit(".,!?\"'()[]{}:;"))


def labels(word, stop: list[str] = P.STOP_WORDS) -> Column:
    """Whether a trimmed word can stand in a label."""
    return (F.length(word) > 2) & ~word.isin(stop) & ~word.startswith("@") & ~word.startswith("http")


def short_count(n) -> Column:
    """12.3M, 45k or 678; halves round up."""
    n = _c(n)
    return (
        F.when(n >= 1_000_000, F.concat(F.format_number(F.round(n / 1e6, 1), 1), F.lit("M")))
        .when(n >= 1000, F.concat(F.round(n / 1e3, 0).cast("bigint").cast("string"), F.lit("k")))
        .otherwise(n.cast("string"))
    )


def slack_links(text) -> Column:
    return F.regexp_replace(_t(text), r"\[([^\]]+)\]\((https://[^)]+)\)", "<$2|$1>")


def truncated(text, most: int) -> Column:
    t = _t(text)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.substring(t, 1, most - 50), F.lit("\n\n... (truncated)")))


def sanitized(text) -> Column:
    return F.regexp_replace(F.regexp_replace(_t(text), "\\x00", ""), "\n{3,}", "\n\n")


def one_line(text, most: int, mark: str = "") -> Column:
    t = F.replace(_t(text), F.lit("\n"), F.lit(" "))
    return F.when(F.length(t) > most, F.concat(F.substring(t, 1, most), F.lit(mark))).otherwise(t)
