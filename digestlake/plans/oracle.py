"""The queries of plans.catalog in DuckDB SQL, from the same catalogues of patterns."""

from __future__ import annotations

from digestlake.functions import patterns as P
from digestlake.sources.posts import view_sql


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def array(names: list[str]) -> str:
    return "[" + ", ".join(map(q, names)) + "]"


def mapping(d: dict) -> str:
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in d.items()) + "}"


def has(text: str, patterns: list[str]) -> str:
    return f"regexp_matches({text}, {q(P.any_re2(patterns))})"


def occurs(text: str, patterns: list[str], low: str = "low", known: str = "known") -> str:
    """has(text, patterns), given the lower-cased text and its distinct words: single words are looked up, and an expression is searched only where what it needs is there."""
    alone, out = [], []
    for pattern in patterns:
        forms, maybe = P.needs(pattern), []
        for words, parts, exact in forms or []:
            if exact:
                alone += words
            else:
                maybe.append(" AND ".join([f"list_contains({known}, {q(w)})" for w in words] + [f"contains({low}, {q(part)})" for part in parts]))
        if maybe or forms is None:
            out.append(f"CASE WHEN ({' OR '.join(maybe)}) THEN {has(text, [pattern])} ELSE false END" if maybe else has(text, [pattern]))
    return "(" + " OR ".join([f"list_has_any({known}, {array(alone)})"] * bool(alone) + out) + ")"


def hits(text: str, patterns: list[str]) -> str:
    return "(" + " + ".join(f"CAST({occurs(text, [p])} AS INTEGER)" for p in patterns) + ")"


def found(text: str, pattern: str, group: int = 1) -> str:
    return f"regexp_extract_all({text}, {q(pattern)}, {group})"


TAG, AT = f"#({P.WORD}+)", f"@({P.WORD}+)"
URL = r"https?://[^\s\p{Z}]+"
TOKENS = f"list_filter(regexp_split_to_array(text, {q(P.BLANK + '+')}), lambda w: w <> '')"
BARE = f"list_filter(list_transform({TOKENS}, lambda w: regexp_replace(w, {q(P.NOT_WORD)}, '', 'g')), lambda w: regexp_matches(w, '^\\p{{Lu}}'))"
NEWS_ENTITIES = f"list_concat(list_filter({BARE}, lambda w: length(w) > 2 AND NOT list_contains({array(P.NOT_NEWS)}, lower(w))), {found('text', TAG)})"
CAP_ENTITIES = f"list_distinct(list_concat(list_filter({BARE}, lambda w: length(w) > 1 AND NOT list_contains({array(P.NOT_ENTITIES)}, w)), {found('text', TAG)}, {found('text', r'\$([A-Z]{2,5})')}))"


def _topics() -> str:
    cases = []
    for topic, patterns in P.TOPICS.items():
        who = array([a for a, t in P.ACCOUNT_TOPICS.items() if t == topic] or [""])
        cases.append(f"CASE WHEN {occurs('low', patterns)} OR list_has_any(ments, {who}) OR len(list_filter(tags, lambda h: {has('h', patterns)})) > 0 THEN {q(topic)} END")
    every = f"list_filter([{', '.join(cases)}], lambda t: t IS NOT NULL)"
    return f"CASE WHEN len({every}) > 0 THEN {every} ELSE ['general'] END"


def _canonical() -> str:
    other = ", ".join(f"CASE WHEN contains(text, {q(w)}) THEN {q(P.SYNONYMS[w])} END" for w in P.SYNONYMS if not w.isascii())
    tickers = found("text", rf"(\$[A-Za-z]{{2,6}})(?:$|{P.NOT_WORD})")
    parts = [
        f"list_transform({tickers}, lambda w: coalesce(syn[lower(w)], upper(w)))",
        f"list_transform({found('text', TAG)}, lambda w: coalesce(syn[lower(w)], '#' || w))",
        f"list_transform({found('lower(text)', '[a-z0-9]{2,}', 0)}, lambda w: syn[w])",
        f"[{other}]",
        f"list_transform({found('text', '[A-Z][A-Za-z]{2,}', 0)}, lambda w: coalesce(syn[lower(w)], CASE WHEN NOT list_contains({array(P.NOT_PROPER)}, w) THEN w END))",
    ]
    return f"list_distinct(list_filter(list_concat({', '.join(parts)}), lambda e: e IS NOT NULL))"


TIER = "CASE WHEN likes >= 50000 THEN 'viral' WHEN likes >= 10000 THEN 'high' WHEN likes >= 1000 THEN 'medium' ELSE 'low' END"
TYPE = "CASE WHEN is_retweet THEN 'retweet' WHEN is_quote THEN 'quote' WHEN starts_with(text, '@') THEN 'reply' ELSE 'original' END"
BARE_TEXT = f"regexp_replace(regexp_replace(text, {q(URL)}, '', 'g'), {q(f'^{P.BLANK}+|{P.BLANK}+$')}, '', 'g')"
PROMO = f"""least(1::DOUBLE, least({hits('text', P.CALLS_TO_ACTION)} * 0.35::DOUBLE, 0.7::DOUBLE) + CASE WHEN {occurs('text', P.THREAD_BAIT)} THEN 0.1::DOUBLE ELSE 0 END
  + CASE WHEN {occurs('text', P.AFFILIATE_LINKS)} THEN 0.3::DOUBLE ELSE 0 END + CASE WHEN {has('lower(screen_name)', P.PROMO_ACCOUNTS)} THEN 0.2::DOUBLE ELSE 0 END
  + CASE WHEN len({found('text', TAG)}) > 4 THEN 0.15::DOUBLE ELSE 0 END + CASE WHEN len({found('text', P.EMOJI, 0)}) > 6 THEN 0.1::DOUBLE ELSE 0 END
  + CASE WHEN length({BARE_TEXT}) < 30 AND contains(text, 'http') THEN 0.1::DOUBLE ELSE 0 END)"""


def _ratio(first: str, high: str, second: str, low: str) -> str:
    return f"CASE WHEN followers > 100 AND likes / followers > {first}::DOUBLE THEN {high}::DOUBLE WHEN followers > 100 AND likes / followers > {second}::DOUBLE THEN {low}::DOUBLE ELSE 0 END"


NEWS = f"""least(1::DOUBLE, least({hits('text', P.NEWS)} * 0.1::DOUBLE, 0.2::DOUBLE) + least({hits('text', P.FACTS)} * 0.05::DOUBLE, 0.15::DOUBLE)
  + CASE WHEN corroboration > 1 THEN least((corroboration - 1) * 0.075::DOUBLE, 0.3::DOUBLE) ELSE 0 END + {_ratio('0.1', '0.15', '0.01', '0.08')}
  + CASE WHEN NOT starts_with(text, '@') THEN 0.1::DOUBLE ELSE 0 END + CASE WHEN verified OR followers >= 50000 THEN 0.1::DOUBLE ELSE 0 END)"""
RELIABILITY = f"""greatest(0::DOUBLE, CASE WHEN curated THEN 0.35::DOUBLE ELSE 0 END + CASE WHEN verified THEN 0.40::DOUBLE ELSE 0 END
  + CASE WHEN followers > 0 THEN 0.25::DOUBLE * least(1::DOUBLE, log10((followers + 1)::DOUBLE) / 6::DOUBLE) ELSE 0 END + {_ratio('0.05', '0.15', '0.01', '0.075')}
  + 0.20::DOUBLE * news_score - 0.10::DOUBLE * promo_score
  - CASE WHEN NOT verified AND NOT curated AND followers > 0 AND followers < 2000 AND likes / greatest(followers, 1) > 1.5::DOUBLE THEN 0.30::DOUBLE ELSE 0 END)"""
CLEAN = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, {u}, '', 'g'), {t}, '', 'g'), {r}, ''), {v}, '\\1', 'g'), {a}, '@USER', 'g'), {h}, '\\1', 'g'), {b}, ' ', 'g'), ' ')".format(
    u=q(URL), t=q(r"t\.co/[^\s\p{Z}]+"), r=q(rf"^RT{P.BLANK}+"), v=q(rf"(^|{P.NOT_WORD})via{P.BLANK}+@{P.WORD}+"), a=q(f"@{P.WORD}+"), h=q(TAG), b=q(P.BLANK + "+")
)
CURATED = "['src0', 'src3', 'src7']"
AS_OF = "TIMESTAMP '2024-01-04 00:00:00'"

_BASE = {
    "posts": view_sql(),
    "worded": f"SELECT *, translate(lower(text), 'ſ', 's') AS low, list_distinct(regexp_split_to_array(translate(lower(text), 'ſ', 's'), {q(P.NOT_WORD + '+')})) AS known FROM posts",
    "own": "SELECT * FROM posts WHERE NOT is_retweet",
    "own_worded": "SELECT * FROM worded WHERE NOT is_retweet",
    "copied": "SELECT * FROM posts UNION ALL SELECT * REPLACE ('again' AS _query, _ord + 1000000000 AS _ord) FROM posts WHERE _ord % 7 = 0",
    "marked": f"SELECT *, {found('lower(text)', TAG)} AS tags, {found('lower(text)', AT)} AS ments FROM worded",
    "topical": f"SELECT * EXCLUDE (low, known), {_topics()} AS topics FROM marked",
    "corr": f"SELECT entity, count(DISTINCT screen_name) AS users FROM (SELECT screen_name, lower(unnest({NEWS_ENTITIES})) AS entity FROM own) GROUP BY entity",
    "corroborated": f"SELECT w.*, coalesce(best.c, 0) AS corroboration FROM own_worded w LEFT JOIN (SELECT id, max(users) AS c FROM (SELECT id, lower(unnest({NEWS_ENTITIES})) AS entity FROM own) JOIN corr USING (entity) GROUP BY id) best USING (id)",
    "raw": f"SELECT * EXCLUDE (low, known), {PROMO} AS promo_raw, {NEWS} AS news_raw FROM corroborated",
    "scored": "SELECT *, round(promo_raw, 3) AS promo_score, round(news_raw, 3) AS news_score FROM raw",
    "kept": "SELECT * FROM scored WHERE promo_raw < 0.4::DOUBLE",
    "known": f"SELECT *, list_contains({CURATED}, lower(screen_name)) AS curated FROM kept",
    "rated": f"SELECT *, (curated OR verified) AS trusted, (verified OR curated OR followers >= 5000) AS quality_account, round({RELIABILITY}, 9) AS reliability FROM known",
    "syns": f"SELECT {mapping(P.SYNONYMS)} AS syn",
    "named": f"SELECT p.*, unnest({_canonical()}) AS entity FROM rated p, syns",
}
_MOMENTUM = f"""SELECT *, (quality + 0.5::DOUBLE * n_verified + 0.5::DOUBLE * recent) * CASE WHEN list_contains({array(P.BROAD)}, entity) THEN 0.6::DOUBLE ELSE 1::DOUBLE END AS momentum FROM (
  SELECT entity, count(*) AS tweets, count(DISTINCT CASE WHEN quality_account THEN screen_name END) AS quality, count(DISTINCT CASE WHEN verified THEN screen_name END) AS n_verified,
    count(DISTINCT CASE WHEN curated THEN screen_name END) AS n_curated, CAST(sum(likes) AS BIGINT) AS likes, count(*) FILTER (ts >= {AS_OF} - INTERVAL 12 HOUR) AS recent FROM {{named}} GROUP BY entity)"""
_BASE |= {
    "strength": _MOMENTUM.format(named="named"),
    "top": "SELECT *, row_number() OVER (ORDER BY momentum DESC, entity) AS story FROM strength WHERE quality >= 2 QUALIFY story <= 12",
    "pairs": f"SELECT n.id, n.entity, t.story, row_number() OVER (PARTITION BY n.id ORDER BY list_contains({array(P.BROAD)}, n.entity), t.momentum DESC, t.story) AS k FROM named n JOIN top t USING (entity)",
    "assigned": "SELECT r.*, b.entity AS story_entity, b.story FROM rated r LEFT JOIN (SELECT * FROM pairs WHERE k = 1) b USING (id)",
    "sources": "SELECT *, row_number() OVER (PARTITION BY story ORDER BY trusted DESC, reliability DESC, _ord) AS rn FROM assigned WHERE story IS NOT NULL QUALIFY rn <= 6",
    "others": "SELECT *, row_number() OVER (ORDER BY trusted DESC, reliability DESC, _ord) AS rn FROM assigned WHERE story IS NULL QUALIFY rn <= 8",
    "clustered": f"SELECT *, coalesce(list_position({array(list(P.TOPICS))}, topics[1]), 0) - 1 AS cluster, {CLEAN} AS clean_text FROM topical WHERE NOT is_retweet",
    "by_topic": f"SELECT *, topics[1] AS topic, count(*) OVER (PARTITION BY topics[1]) AS tweet_count, row_number() OVER (PARTITION BY topics[1] ORDER BY CASE {TIER} WHEN 'viral' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END, likes DESC, _ord) AS rn FROM topical WHERE NOT is_retweet QUALIFY tweet_count >= 5 AND rn <= 100",
    "said": f"SELECT id, cluster, unnest(list_filter(list_transform(list_filter(regexp_split_to_array(lower(text), {q(P.BLANK + '+')}), lambda w: w <> ''), lambda w: trim(w, {q('.,!?"' + chr(39) + '()[]{}:;')})), lambda w: length(w) > 2 AND NOT starts_with(w, '@') AND NOT starts_with(w, 'http'))) AS word FROM clustered",
    "words": f"SELECT cluster, word, count(*) AS n FROM said WHERE NOT list_contains({array(P.STOP_WORDS)}, word) GROUP BY ALL",
    "common_words": "SELECT word FROM said GROUP BY word HAVING count(DISTINCT id) > 0.2::DOUBLE * (SELECT count(*) FROM clustered)",
    "words_listed": "SELECT cluster, word, count(*) AS n FROM said ANTI JOIN common_words USING (word) GROUP BY ALL",
    "labelled": "SELECT c.cluster, coalesce(l.label, 'misc') AS label FROM (SELECT DISTINCT cluster FROM clustered) c LEFT JOIN (SELECT cluster, string_agg(word, ' / ' ORDER BY k) AS label FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, word) AS k FROM words) WHERE k <= 3 GROUP BY cluster) l USING (cluster)",
    "labelled_listed": "SELECT c.cluster, coalesce(l.label, 'misc') AS label FROM (SELECT DISTINCT cluster FROM clustered) c LEFT JOIN (SELECT cluster, string_agg(word, ' / ' ORDER BY k) AS label FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, word) AS k FROM words_listed) WHERE k <= 3 GROUP BY cluster) l USING (cluster)",
}
_NEEDS = {
    "own": ["posts"], "copied": ["posts"], "worded": ["posts"], "own_worded": ["worded"], "marked": ["worded"], "topical": ["marked"], "corr": ["own"], "corroborated": ["own", "own_worded", "corr"], "raw": ["corroborated"], "scored": ["raw"], "kept": ["scored"],
    "known": ["kept"], "rated": ["known"], "named": ["rated", "syns"], "strength": ["named"], "top": ["strength"], "pairs": ["named", "top"], "assigned": ["rated", "pairs"], "sources": ["assigned"], "others": ["assigned"],
    "clustered": ["topical"], "by_topic": ["topical"], "said": ["clustered"], "words": ["said"], "common_words": ["said", "clustered"], "words_listed": ["said", "common_words"], "labelled": ["clustered", "words"], "labelled_listed": ["clustered", "words_listed"],
}


#: Views whose columns are costly, and which are read more than once.
_ONCE = ("worded", "marked", "topical", "clustered", "corroborated", "raw", "rated", "named", "own", "by_topic", "said")


def _with(needs: list[str], select: str, **more: str) -> str:
    """select with the views that it needs, and those that they need, before it."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    views = [f"{n} AS {'MATERIALIZED ' * (n in _ONCE)}({_BASE[n]})" for n in order] + [f"{n} AS ({sql})" for n, sql in more.items()]
    return f"WITH {', '.join(views)} {select}" if views else select


def _prompt(rows: str, group: str, head: str) -> str:
    ask = q("\n\nSummarize the key narratives, stories, and sentiment in these tweets.\nInclude specific examples with @handles and tweet IDs for sourcing.\nFocus on: What's happening? Why does it matter? What's the sentiment?\n\n---\n\n")
    line = "'[' || rn || '] @' || screen_name || ' (' || format('{:,}', likes) || ' likes)' || chr(10) || 'ID: ' || id || chr(10) || 'Text: ' || substr(replace(text, chr(10), ' '), 1, 500) || chr(10)"
    return f"SELECT {group}, count(*) AS n, {head} || chr(10) || '# Tweet count: ' || count(*) || {ask} || string_agg({line}, chr(10) ORDER BY rn) AS prompt FROM {rows} GROUP BY {group}"


def _gram_counts(rows: str, key: str, stop: list[str]) -> dict[str, str]:
    words = f"list_filter({found('lower(clean_text)', P.WORD + '{2,}', 0)}, lambda w: NOT list_contains({array(stop)}, w))"
    return {
        "tok": f"SELECT {key}, {words} AS w FROM {rows}",
        "gram": f"SELECT {key}, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM tok",
        "tf": f"SELECT {key}, term, count(*) AS tf FROM gram GROUP BY ALL",
    }


def _weights(key: str, docs: str, having: str, features: int) -> dict[str, str]:
    return {
        "terms": f"SELECT term, ln((1 + {docs}) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY term {having} ORDER BY sum(tf) DESC, term LIMIT {features}",
        "raw_w": "SELECT *, tf * idf AS x FROM tf JOIN terms USING (term)",
        "weights": f"SELECT {key}, term, x / sqrt(sum(x * x) OVER (PARTITION BY {key})) AS weight FROM raw_w",
    }


def _digest_lines() -> str:
    post = "['- ' || CASE WHEN curated THEN '★ ' ELSE '' END || CASE WHEN verified THEN '✅ ' ELSE '' END || '**@' || screen_name || '** (' || format('{:,}', likes) || ' likes · ' || CASE WHEN followers >= 1000000 THEN printf('%.1f', round(followers / 1e6, 1)) || 'M' WHEN followers >= 1000 THEN CAST(round(followers / 1e3) AS BIGINT) || 'k' ELSE CAST(followers AS VARCHAR) END || ' followers): ' || CASE WHEN length(text) > 220 THEN substr(replace(text, chr(10), ' '), 1, 220) || '...' ELSE replace(text, chr(10), ' ') END, '  [source](https://x.com/' || screen_name || '/status/' || id || ')', '']"
    part = lambda section, place, rank, lines, rest: f"SELECT {section} AS section, CAST({place} AS BIGINT) AS part, CAST({rank} AS BIGINT) AS rank, {lines} AS lines FROM {rest}"
    total = "(SELECT count(*) AS n, count(DISTINCT screen_name) AS a, count(DISTINCT CASE WHEN curated THEN screen_name END) AS c FROM assigned)"
    parts = [
        part(0, 0, 0, "['# Digest', '**2024-01-04 00:00 UTC** — ' || n || ' tweets / ' || a || ' accounts (' || c || ' curated sources) / last 48h', '']", total),
        part(0, 0, 1, "['*No tweets to report.*']", f"{total} WHERE n = 0"),
        part(1, 0, 0, "['---', '', '## 🔥 Momentum (last 48h)', '*Accounts = distinct quality accounts (curated / verified / 5k+ followers).*', '']", f"{total} WHERE n > 0"),
        part(1, 0, 1, "CASE WHEN k > 0 THEN ['| Topic | Tweets | Accounts | Verified | Total likes |', '|---|---|---|---|---|'] ELSE ['*No topic reached the momentum threshold.*', ''] END", "(SELECT count(*) AS k FROM top) WHERE (SELECT count(*) FROM assigned) > 0"),
        part(1, "story", 2, "['| ' || entity || ' | ' || tweets || ' | ' || quality || ' | ' || n_verified || ' | ' || format('{:,}', likes) || ' |']", "top"),
        part(1, 1000000, 3, "['']", "(SELECT count(*) AS k FROM top) WHERE k > 0"),
        part(2, 0, 0, "['---', '', '## 📰 Stories (by momentum; sources trusted-first)', '']", f"{total} WHERE n > 0"),
        part(2, "story", 0, "['### ' || entity || ' — ' || tweets || ' tweets / ' || quality || ' accounts / ' || n_verified || ' verified', '']", "top WHERE story IN (SELECT story FROM sources)"),
        part(2, "story", "rn", post, "sources"),
        part(2, "story", 1000000, "['']", "top WHERE story IN (SELECT story FROM sources)"),
        part(3, 0, 0, "['---', '', '## Other notable (trusted-first)', '']", "(SELECT count(*) AS k FROM others) WHERE k > 0"),
        part(3, 1, "rn", post, "others"),
    ]
    return _with(["sources", "others", "top", "assigned"], "SELECT section, part, rank, CAST(i - 1 AS BIGINT) AS line_no, lines[i] AS line FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM (" + " UNION ALL ".join(parts) + "))")


_SIL = """WITH p AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
  d AS (SELECT a.vec_id, a.label AS c, b.label AS o, sum(list_distance(a.v, b.v)) AS total, count(*) AS n FROM p a JOIN p b ON true GROUP BY ALL),
  e AS (SELECT vec_id, max(CASE WHEN c = o AND n > 1 THEN total / (n - 1) END) AS a, min(CASE WHEN c <> o THEN total / n END) AS b FROM d GROUP BY vec_id),
  s AS (SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM e) """
#: Distances to nine digits, those to the fifth nearest point, the spanning tree grown a point at a time from all distances, and what its edges say of the clusters. Edges are ordered by (w, u, v).
_TREE = """p AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS i, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
  near AS MATERIALIZED (SELECT a.i, list(round(list_distance(a.v, b.v), 9) ORDER BY b.i) AS d FROM p a, p b GROUP BY a.i),
  cored AS MATERIALIZED (SELECT i, d, list_sort(d)[least(5, len(d))] AS core FROM near),
  cores AS (SELECT list(core ORDER BY i) AS c, count(*) AS n FROM cored),
  reach AS MATERIALIZED (SELECT i, n, list_transform(range(1, n + 1), lambda j: greatest(d[j], core, c[j])) AS w FROM cored, cores),
  grown(step, now, best, edge) AS (
    SELECT 0, 1::BIGINT, list_transform(range(1, n + 1), lambda j: CASE WHEN j > 1 THEN {'w': 1e300::DOUBLE, 'u': 0::BIGINT, 'v': 0::BIGINT, 'j': j} END), NULL::STRUCT(w DOUBLE, u BIGINT, v BIGINT, j BIGINT) FROM cores
    UNION ALL
    SELECT step + 1, e.j, list_transform(b, lambda x: CASE WHEN x.j <> e.j THEN x END), e FROM (
      SELECT step, b, list_aggregate(b, 'min') AS e FROM (
        SELECT step, list_transform(range(1, n + 1), lambda j: CASE WHEN best[j] IS NOT NULL THEN least(best[j], {'w': r.w[j], 'u': least(now, j), 'v': greatest(now, j), 'j': j}) END) AS b
        FROM grown JOIN reach r ON r.i = now WHERE step < n - 1))),
  tree AS MATERIALIZED (SELECT edge.w AS w, a.label AS a, z.label AS z FROM grown JOIN p a ON a.i = edge.u JOIN p z ON z.i = edge.v),
  sized AS (SELECT label AS c, count(*) AS size FROM p WHERE label <> -1 GROUP BY label),
  apart AS (SELECT c, min(w) AS w FROM (SELECT w, unnest([a, z]) AS c FROM tree WHERE a <> z AND a <> -1 AND z <> -1) GROUP BY c),
  judged AS (SELECT c, size, coalesce((SELECT max(w) FROM tree WHERE a = s.c AND z = s.c), 0) AS inner_w,
    coalesce(apart.w, 2 * CASE WHEN (SELECT count(*) FROM sized) > 1 THEN (SELECT max(w) FROM tree) ELSE coalesce((SELECT min(w) FROM tree WHERE (a = -1) <> (z = -1)), (SELECT max(w) FROM tree)) END) AS outer_w
    FROM sized s LEFT JOIN apart USING (c)),
  rv AS (SELECT sum(size / (SELECT count(*) FROM p) * CASE WHEN greatest(inner_w, outer_w) > 0 THEN (outer_w - inner_w) / greatest(inner_w, outer_w) ELSE 0 END) AS relative_validity FROM judged)"""
_CENTERS = """WITH m AS (SELECT label AS cluster, i - 1 AS place, avg(embedding[i]::DOUBLE) AS x FROM embeddings, range(1, 65) r(i) GROUP BY ALL),
  u AS (SELECT cluster, CAST(place AS BIGINT) AS place, x / sqrt(sum(x * x) OVER (PARTITION BY cluster)) AS x FROM m) """


def queries() -> dict[str, str]:
    joined = lambda name, sql: _with(["posts"], f"SELECT id, array_to_string({sql}, '|') AS {name} FROM posts")
    entities_of = lambda names: "list_filter([" + ", ".join(f"CASE WHEN {occurs('text', [P.exactly(n)])} THEN {q(n)} END" for n in names) + "], lambda x: x IS NOT NULL)"
    force = "CASE WHEN list_contains({l}, {t}) THEN {l} ELSE list_concat([{t}], {l}) END"
    bare = "list_filter(topics, lambda t: t <> 'general')"
    forced = force.format(l="f", t="'crypto'")
    out = {
        "dedup_first": _with(["copied"], "SELECT id, _query, likes FROM copied QUALIFY row_number() OVER (PARTITION BY id ORDER BY _ord) = 1"),
        "dedup_provenance": _with(["copied"], "SELECT id, string_agg(_query, '|' ORDER BY _ord) AS _query, arg_min(likes, _ord) AS likes FROM copied GROUP BY id"),
        "union_queries": _with(["copied"], "SELECT _query, count(*) AS n FROM copied GROUP BY _query"),
        "age_filter": _with(["posts"], f"SELECT id, created_at FROM posts WHERE ts >= {AS_OF} - INTERVAL 48 HOUR"),
        "originals": _with(["own"], "SELECT id FROM own"),
        "search_filters": _with(["posts"], f"SELECT id, likes FROM posts WHERE likes >= 1000 AND len({found('text', URL, 0)}) > 0 AND {TYPE} <> 'reply'"),
        "parse_ts": _with(["posts"], "SELECT id, ts AS parsed FROM posts"),
        "hashtags": joined("hashtags", found("lower(text)", TAG)), "mentions": joined("mentions", found("lower(text)", AT)), "urls": joined("urls", found("text", URL, 0)),
        "cashtags": joined("cashtags", found("text", r"\$([A-Z]{2,5})")), "news_entities": joined("news_entities", NEWS_ENTITIES), "cap_entities": joined("cap_entities", f"list_sort({CAP_ENTITIES})"),
        "canonical_entities": _with(["posts", "syns"], f"SELECT id, array_to_string(list_sort({_canonical()}), '|') AS canonical_entities FROM posts, syns"),
        "topics_text": _with(["topical"], "SELECT id, array_to_string(topics, '|') AS topics_text FROM topical"),
        "clean_text": _with(["posts"], f"SELECT id, {CLEAN} AS clean_text FROM posts"),
        "companies_products": _with(["worded"], f"SELECT id, array_to_string({entities_of(P.COMPANIES)}, '|') AS companies, array_to_string({entities_of(P.PRODUCTS)}, '|') AS products FROM worded"),
        "enrich_force": _with(["topical", "worded"], f"SELECT id, array_to_string({forced}, '|') AS topics, engagement_tier, content_type, companies FROM (SELECT *, {force.format(l=bare, t=q('finance'))} AS f, {TIER} AS engagement_tier, {TYPE} AS content_type, array_to_string({entities_of(P.COMPANIES)}, '|') AS companies FROM topical JOIN (SELECT id, low, known FROM worded) USING (id))"),
        "primary_topic": _with(["topical"], "SELECT topics[1] AS topic, count(*) AS n FROM topical WHERE NOT is_retweet GROUP BY 1"),
        "topic_distribution": _with(["topical"], "SELECT topic, count(*) AS n FROM (SELECT unnest(topics) AS topic FROM topical WHERE NOT is_retweet) GROUP BY topic"),
        "tier_distribution": _with(["own"], f"SELECT {TIER} AS tier, count(*) AS n FROM own GROUP BY 1"),
        "content_type_distribution": _with(["posts"], f"SELECT {TYPE} AS content_type, count(*) AS n FROM posts GROUP BY 1"),
        "topic_share": _with(["topical", "own"], "SELECT topic, count(*) AS n, round(100::DOUBLE * count(*) / (SELECT count(*) FROM own), 4) AS pct FROM (SELECT unnest(topics) AS topic FROM topical WHERE NOT is_retweet) GROUP BY topic"),
        "corpus_stats": _with(["posts"], "SELECT count(*) AS n, count(DISTINCT screen_name) AS accounts, CAST(sum(likes) AS BIGINT) AS likes, round(100::DOUBLE * count(*) FILTER (is_retweet) / count(*), 4) AS retweet_pct FROM posts"),
        "promo_score": _with(["worded"], f"SELECT id, round({PROMO}, 3) AS promo_score FROM worded"),
        "corroboration": _with(["corr"], "SELECT entity, users FROM corr"),
        "news_score": _with(["scored"], "SELECT id, corroboration, news_score FROM scored"),
        "filter_score": _with(["kept"], "SELECT id, promo_score, news_score, round(news_score - 0.5::DOUBLE * promo_score, 6) AS composite FROM kept"),
        "strict_filter": _with(["scored"], "SELECT id, promo_score, news_score FROM scored WHERE promo_raw < 0.3::DOUBLE AND news_raw >= 0.15::DOUBLE"),
        "filter_counters": _with(["scored"], "SELECT count(*) AS n, count(*) FILTER (promo_raw >= 0.3::DOUBLE) AS promo_removed, count(*) FILTER (promo_raw < 0.3::DOUBLE AND news_raw < 0.15::DOUBLE) AS news_removed FROM scored"),
        "score_stats": _with(["scored"], "SELECT min(promo_score) AS promo_score_min, max(promo_score) AS promo_score_max, round(avg(promo_score), 6) AS promo_score_mean, min(news_score) AS news_score_min, max(news_score) AS news_score_max, round(avg(news_score), 6) AS news_score_mean FROM scored"),
        "top_newsworthy": _with(["kept"], "SELECT id, news_score, promo_score FROM kept ORDER BY news_score - 0.5::DOUBLE * promo_score DESC, _ord LIMIT 10"),
        "topk_likes": _with(["posts"], "SELECT id, likes FROM posts ORDER BY likes DESC, _ord LIMIT 5"),
        "prioritised": _with(["by_topic"], "SELECT topic, rn, id, tweet_count FROM by_topic"),
        "topic_prompt": _with(["by_topic"], _prompt("by_topic", "topic", "'# Topic: ' || upper(topic)")),
        "topic_manifest": _with(["by_topic"], "SELECT topic, max(tweet_count) AS tweet_count, count(*) AS prioritized_count, topic || '.txt' AS file FROM by_topic GROUP BY topic"),
        "reliability": _with(["scored"], f"SELECT id, (curated OR verified) AS trusted, round({RELIABILITY}, 6) AS reliability FROM (SELECT *, list_contains({CURATED}, lower(screen_name)) AS curated FROM scored)"),
        "momentum_entities": _with(["own", "syns"], "SELECT * REPLACE (round(momentum, 6) AS momentum) FROM all_strength", flagged=f"SELECT *, list_contains({CURATED}, lower(screen_name)) AS curated, (verified OR list_contains({CURATED}, lower(screen_name)) OR followers >= 5000) AS quality_account FROM own", all_named=f"SELECT p.*, unnest({_canonical()}) AS entity FROM flagged p, syns", all_strength=_MOMENTUM.format(named="all_named")),
        "top_stories": _with(["top"], "SELECT story, entity, tweets, quality, round(momentum, 6) AS momentum FROM top"),
        "story_assignment": _with(["assigned"], "SELECT id, story_entity FROM assigned WHERE story IS NOT NULL"),
        "story_sources": _with(["sources"], "SELECT story_entity, rn, id FROM sources"),
        "other_notable": _with(["others"], "SELECT rn, id FROM others"),
        "digest_lines": _digest_lines(),
        "label_words": _with(["labelled"], "SELECT CAST(cluster AS INTEGER) AS cluster, label FROM labelled"),
        "label_words_listed": _with(["labelled_listed"], "SELECT CAST(cluster AS INTEGER) AS cluster, label FROM labelled_listed"),
        "cluster_entities": _with(["clustered"], f"SELECT CAST(cluster AS INTEGER) AS cluster, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, entity) AS rn, entity, n FROM (SELECT cluster, entity, count(*) AS n FROM (SELECT cluster, unnest({CAP_ENTITIES}) AS entity FROM clustered WHERE cluster <> -1) GROUP BY ALL) QUALIFY rn <= 10"),
        "cluster_tiers": _with(["clustered"], "SELECT CAST(cluster AS INTEGER) AS cluster, " + ", ".join(f"count(*) FILTER ({TIER} = '{t}') AS {t}" for t in ("viral", "high", "medium", "low")) + " FROM clustered GROUP BY cluster"),
        "cluster_manifest": _with(["clustered", "labelled"], "SELECT CAST(cluster AS INTEGER) AS cluster, label, count(*) AS tweet_count, least(count(*), 100) AS prioritized_count, 'cluster_' || lpad(CAST(cluster AS VARCHAR), 2, '0') || '_' || substr(replace(replace(label, ' / ', '_'), ' ', '_'), 1, 30) || '.txt' AS file, arg_max(screen_name, (likes, -_ord)) AS top_user, max(likes) AS top_likes, arg_max(id, (likes, -_ord)) AS top_id FROM clustered JOIN labelled USING (cluster) WHERE cluster <> -1 GROUP BY cluster, label"),
        "cluster_prompt": _with(["clustered"], _prompt("best", "CAST(cluster AS INTEGER)", "'# Cluster ' || CAST(cluster AS INTEGER) || ': topic'").replace("SELECT CAST(cluster AS INTEGER),", "SELECT CAST(cluster AS INTEGER) AS cluster,").replace("GROUP BY CAST(cluster AS INTEGER)", "GROUP BY cluster"), best="SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY likes DESC, _ord) AS rn FROM clustered WHERE cluster <> -1 QUALIFY rn <= 100"),
        "noise_viral": _with(["clustered"], "SELECT * FROM (SELECT 'notable' AS kind, row_number() OVER (ORDER BY likes DESC, _ord) AS rn, id, likes FROM clustered WHERE cluster = -1 AND likes >= 1000 QUALIFY rn <= 50) UNION ALL SELECT * FROM (SELECT 'viral' AS kind, row_number() OVER (ORDER BY likes DESC, _ord) AS rn, id, likes FROM clustered WHERE cluster = -1 AND likes >= 5000 QUALIFY rn <= 20)"),
        "tfidf": _with(["own"], "SELECT id, term, round(weight, 6) AS weight FROM weights", cleaned=f"SELECT id, {CLEAN} AS clean_text FROM own", **_gram_counts("cleaned", "id", P.STOP_WORDS), **_weights("id", "(SELECT count(*) FROM own)", "HAVING count(*) >= 2 AND count(*) <= 0.8 * (SELECT count(*) FROM own)", 5000)),
        "tfidf_weighted": _with(["own"], "SELECT id, term, round(weight, 6) AS weight FROM weights", cleaned=f"SELECT id, concat_ws(' ', {CLEAN}, array_to_string(list_concat(e, e), ' '), array_to_string(list_concat(h, h), ' ')) AS clean_text FROM (SELECT id, text, list_sort({CAP_ENTITIES}) AS e, {found('lower(text)', TAG)} AS h FROM own)", **_gram_counts("cleaned", "id", P.STOP_WORDS), **_weights("id", "(SELECT count(*) FROM own)", "HAVING count(*) >= 2 AND count(*) <= 0.8 * (SELECT count(*) FROM own)", 5000)),
        "ctfidf": _with(["clustered"], "SELECT CAST(cluster AS INTEGER) AS cluster, row_number() OVER (PARTITION BY cluster ORDER BY round(weight, 9) DESC, term) AS rn, term, round(weight, 6) AS weight FROM weights QUALIFY rn <= 10", **_gram_counts("(SELECT * FROM clustered WHERE cluster <> -1)", "cluster", P.STOP_WORDS + P.MARKUP_WORDS), **_weights("cluster", "(SELECT count(DISTINCT cluster) FROM clustered WHERE cluster <> -1)", "", 1000)),
        "centroids": _CENTERS + "SELECT cluster, place, round(x, 6) AS x FROM u",
        "soft_assign": _soft("0.5"),
        "secondary_clusters": _soft("0.8"),
        "silhouette": _SIL + "SELECT round(silhouette, 6) AS silhouette FROM s",
        "core_distances": f"WITH RECURSIVE {_TREE} SELECT vec_id, round(core, 6) AS core FROM cored JOIN p USING (i)",
        "relative_validity": f"WITH RECURSIVE {_TREE} SELECT round(relative_validity, 6) AS relative_validity FROM rv",
        "quality_gate": _SIL.replace("WITH p AS", f"WITH RECURSIVE {_TREE}, pt AS").replace("FROM p a JOIN p b", "FROM pt a JOIN pt b") + ", n AS (SELECT count(*) FILTER (label = -1) AS noise_count, avg(CAST(label = -1 AS INTEGER)) AS f, count(DISTINCT CASE WHEN label <> -1 THEN label END) AS n_clusters FROM embeddings) SELECT round(relative_validity, 6) AS relative_validity, round(silhouette, 6) AS silhouette, round(f, 6) AS noise_fraction, noise_count, n_clusters, coalesce(relative_validity > 0, true) AND coalesce(silhouette > 0.05, true) AND f < 0.35 AS quality_pass FROM s, n, rv",
        "hybrid_vector": "SELECT vec_id, CAST(len(h) AS BIGINT) AS dims, round(1::DOUBLE, 6) AS length, round(list_dot_product(e, e) / sqrt(list_dot_product(h, h)), 5) AS along FROM (SELECT vec_id, embedding::DOUBLE[] AS e, list_concat(embedding::DOUBLE[], list_transform(embedding[1:8]::DOUBLE[], lambda x: x * 0.35::DOUBLE)) AS h FROM embeddings)",
        "slack_links": _with(["posts"], r"SELECT id, regexp_replace('[source](https://x.example/' || id || ') ' || text || ' [no](http://plain)', '\[([^\]]+)\]\((https://[^)]+)\)', '<\2|\1>', 'g') AS linked FROM posts"),
        "truncate": "SELECT doc_id, " + ", ".join(f"CASE WHEN length(text) <= {n} THEN text ELSE substr(text, 1, {n - 50}) || chr(10) || chr(10) || '... (truncated)' END AS {name}" for name, n in (("slack", 3500), ("discord", 1900))) + " FROM documents",
        "sanitize": r"SELECT doc_id, regexp_replace(replace(text, '. ', repeat(chr(10), 4)), '\n{3,}', chr(10) || chr(10), 'g') AS clean FROM documents",
        "chunk_3500": "SELECT doc_id, n, k AS of, '(' || n || '/' || k || ') ' || substr(text, (n - 1) * 3500 + 1, 3500) AS chunk FROM (SELECT doc_id, text, CAST(ceil(length(text) / 3500.0) AS BIGINT) AS k, unnest(range(1, CAST(ceil(length(text) / 3500.0) AS BIGINT) + 1)) AS n FROM documents)",
        "ranked_posts": _with(["kept"], "SELECT row_number() OVER (ORDER BY composite DESC, _ord) AS rank, id, composite FROM (SELECT *, round(news_score - 0.5::DOUBLE * promo_score, 6) AS composite FROM kept)"),
        "clusters_by_size": _with(["clustered"], "SELECT row_number() OVER (ORDER BY count(*) DESC, cluster) AS rank, CAST(cluster AS INTEGER) AS cluster, count(*) AS n FROM clustered WHERE cluster <> -1 GROUP BY cluster"),
        "corpus_guard": _with(["own"], "SELECT id, 'all' AS of FROM own WHERE (SELECT count(*) FROM own) >= 20"),
        "hybrid_files": _with(["labelled"], r"SELECT CAST(cluster AS INTEGER) AS cluster, 'cluster_' || lpad(CAST(cluster AS VARCHAR), 2, '0') || '_' || substr(regexp_replace(regexp_replace(label, '[^\p{L}\p{N}_\s-]', '', 'g'), '\s+', '_', 'g'), 1, 40) || '.txt' AS file FROM labelled WHERE cluster <> -1"),
        "viral_prompt": _with(["clustered"], _alone("# Viral Highlights\n# High-engagement tweets that didn't fit into topic clusters", "These are standalone viral tweets - unique content that resonated but doesn't\nbelong to a trending topic or narrative. Worth including in the digest."), best="SELECT *, row_number() OVER (ORDER BY likes DESC, _ord) AS rn FROM clustered WHERE cluster = -1 AND likes >= 5000 QUALIFY rn <= 20"),
        "noise_prompt": _with(["clustered"], _alone("# Cluster -1: uncategorized (noise)", _ASK), best="SELECT *, row_number() OVER (ORDER BY likes DESC, _ord) AS rn FROM clustered WHERE cluster = -1 AND likes >= 1000 QUALIFY rn <= 50"),
        "views_cast": _with(["posts"], "SELECT id, CASE WHEN likes % 3 = 1 THEN likes ELSE 0 END AS views FROM posts"),
        "cluster_vectors": _with(["posts"], "SELECT id, label AS cluster, screen_name, likes, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 4) AS length FROM posts JOIN embeddings ON id = CAST(vec_id AS VARCHAR)"),
        "vector_prompts": _with(["own"], _prompt("best", "cluster", "'# Cluster ' || cluster || ': vectors'"), best="SELECT own.*, label AS cluster, row_number() OVER (PARTITION BY label ORDER BY likes DESC, _ord) AS rn FROM own JOIN embeddings ON id = CAST(vec_id AS VARCHAR) WHERE label <> -1 QUALIFY rn <= 100"),
        "timeline_posts": _with(["posts"], "SELECT id, text, created_at, screen_name, verified, followers, likes, 'captured' AS _query FROM posts WHERE _ord % 10 <> 3"),
        "timeline_replay": _with(["posts"], "SELECT id, text, screen_name, likes, _query FROM posts WHERE (_ord // 3) % 10 <> 3"),
        "search_posts": _with(["posts"], "SELECT id, text, created_at, screen_name, verified, followers, likes, 'captured' AS _query FROM posts WHERE _ord % 10 <> 3 OR _ord % 4 = 1"),
        "page_cursors": _with(["posts"], "SELECT DISTINCT _ord // 25 AS page, 'next-' || (_ord // 25) AS cursor FROM posts"),
        "payloads": _with(["posts"], _payloads()),
        "batches": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(i AS BIGINT) AS n, parts[i] AS chunk FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(list_reduce(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)), lambda a, x: CASE WHEN length(string_split(a, chr(30))[-1]) + length(x) + 4 <= 4000 THEN a || chr(10) || chr(10) || x ELSE a || chr(30) || x END), chr(30)) AS parts FROM documents))",
        "chunks": _chunks(),
    }
    return out


def _soft(least: str) -> str:
    return _CENTERS + """, c AS (SELECT cluster, list(x ORDER BY place) AS v FROM u GROUP BY cluster), s AS (SELECT vec_id, label, c.cluster AS other, list_dot_product(embedding::DOUBLE[], c.v) AS sim FROM embeddings, c),
          o AS (SELECT *, max(CASE WHEN other = label THEN sim END) OVER (PARTITION BY vec_id) AS own FROM s), k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, other) AS r FROM o WHERE other <> label AND (sim >= 0.5::DOUBLE OR own - sim <= 0.03::DOUBLE))
          SELECT e.vec_id, e.label AS cluster, coalesce(g.secondary, '') AS secondary FROM embeddings e LEFT JOIN (SELECT vec_id, string_agg(CAST(other AS VARCHAR), '|' ORDER BY r) AS secondary FROM k WHERE r <= 2 GROUP BY vec_id) g USING (vec_id)""".replace("0.5::DOUBLE", f"{least}::DOUBLE")


_ASK = "Summarize the key narratives, stories, and sentiment in these tweets.\nInclude specific examples with @handles and tweet IDs for sourcing.\nFocus on: What's happening? Why does it matter? What's the sentiment?"


def _alone(head: str, ask: str) -> str:
    line = "'[' || rn || '] @' || screen_name || ' (' || format('{:,}', likes) || ' likes)' || chr(10) || 'ID: ' || id || chr(10) || 'Text: ' || substr(replace(text, chr(10), ' '), 1, 500) || chr(10)"
    return f"SELECT count(*) AS n, {q(head)} || chr(10) || '# Tweet count: ' || count(*) || chr(10) || chr(10) || {q(ask)} || chr(10) || chr(10) || '---' || chr(10) || chr(10) || string_agg({line}, chr(10) ORDER BY rn) AS prompt FROM best HAVING count(*) > 0"


def _payloads() -> str:
    """JSON texts put together by hand; to_json gives the quoted strings."""
    cut = lambda t, n: f"CASE WHEN length({t}) <= {n} THEN {t} ELSE substr({t}, 1, {n - 50}) || chr(10) || chr(10) || '... (truncated)' END"
    quoted = lambda t: f"CAST(to_json({t}) AS VARCHAR)"
    clean = lambda t: f"regexp_replace({t}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    link = r"regexp_replace(text, '\[([^\]]+)\]\((https://[^)]+)\)', '<\2|\1>', 'g')"
    slack = f"""'{{"blocks": [{{"type": "header", "text": {{"type": "plain_text", "text": "Digest", "emoji": true}}}}, {{"type": "section", "text": {{"type":"mrkdwn","text":' || {quoted(cut('linked', 3500))} || '}}}}]}}'"""
    discord = f"""'{{"embeds":[{{"title":"Digest","description":' || {quoted(clean('(' + cut('text', 1900) + ')'))} || ',"color":1942002}}]}}'"""
    webhook = f"""'{{"title":"Digest","content":' || {quoted(cut('text', 2000))} || '}}'"""
    audio = f"""'{{"embeds":[{{"title":"Digest","description":' || {quoted(clean("(CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END)"))} || ',"color":1942002,"footer":{{"text":"Audio briefing attached below"}}}}]}}'"""
    return f"SELECT id, {slack} AS slack, {discord} AS discord, {webhook} AS webhook, {audio} AS audio FROM (SELECT *, {link} AS linked FROM posts)"


def _chunks() -> str:
    """Units carry what joins them before their text: a space for sentences, a blank line for paragraphs. chr(30) ends a chunk, chr(31) a unit, chr(29) stands for the blank line."""
    units = "string_split(list_aggregate(list_transform(string_split(text, chr(10) || chr(10)), lambda p: CASE WHEN length(p) > 4000 THEN ' ' || regexp_replace(p, '([.!?])\\s+', '\\1' || chr(31) || ' ', 'g') ELSE chr(29) || p END), 'string_agg', chr(31)), chr(31))"
    held, unit, joint = "string_split(a, chr(30))[-1]", "substr(x, 2)", "replace(substr(x, 1, 1), chr(29), chr(10) || chr(10))"
    step = f"CASE WHEN {held} = '' THEN a || {unit} WHEN length({held}) + length({unit}) + length({joint}) > 4000 THEN a || chr(30) || {unit} ELSE a || {joint} || {unit} END"
    parts = f"string_split(list_reduce(list_prepend('', {units}), lambda a, x: {step}), chr(30))"
    bare = lambda t: f"regexp_replace({t}, '^[\\s\\x0b]+|[\\s\\x0b]+$', '', 'g')"
    return f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(i AS BIGINT) AS n, CASE WHEN length(text) <= 4000 THEN text ELSE {bare('parts[i]')} END AS chunk FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, text, CASE WHEN length(text) <= 4000 THEN [text] ELSE {parts} END AS parts FROM documents)) WHERE i < len(parts) OR len(parts) = 1 OR {bare('parts[i]')} <> ''"
