"""The queries of this subpackage: thin digests over its operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import centroids, conversations, decontaminate, jaccard, mixing, packing, pii, quality, secrets, sharding, substrings, tokens, toxicity
from .shared import documents


def op1_recurrent_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_multi_order_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_rows(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op3_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.read_files(tokens.write_files(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))


def op5_interval_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against a ledger that an earlier run left behind: its versions, the first tenth by doc_id, are not scanned again."""
    docs, rules = documents(spark, sf_dir), secrets.RULES + secrets.MORE_RULES
    ledger = secrets.Ledger(spark)
    earlier = docs.agg(F.percentile_approx("doc_id", 0.1)).first()[0]
    ledger.update(secrets.versions(docs.where(F.col("doc_id") <= earlier)), rules)
    rows = secrets.scan(docs, ledger, rules)
    every = F.coalesce("spans", F.expr(f"cast(array() as {secrets.SPANS})"))
    names = [r.name for r in secrets.RULES]
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.rule, s.start, s.end)), ",")
    count = lambda rule: F.size(F.filter(every, lambda s: s.rule == rule)).cast("long")
    return rows.select(
        F.col("path").alias("doc_id"),
        *[count(name).alias(f"n_{name}") for name in names],
        F.sha2(joined(F.filter(every, lambda s: s.rule.isin(names))), 256).alias("base_sha256"),
        joined(every).alias("spans"),
    )


def op7_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.interleave(documents(spark, sf_dir), 40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 4096)


def op9_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, source, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
base AS (
  SELECT doc_id, source, text, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d),
grams AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g FROM d, unnest(generate_series(1, len(w) - 7)) AS t(i) WHERE len(w) >= 8),
twice AS (SELECT doc_id, g FROM grams GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM grams JOIN twice USING (doc_id, g), generate_series(0, 7) AS s(k) GROUP BY doc_id),
plain AS (
  SELECT doc_id, source, text, trim(unnest(string_split(lower(regexp_replace(text, '[\x20\x09\x0B-\x0D]+', ' ', 'g')), chr(10))), ' ') AS line
  FROM documents),
hosts AS (SELECT source, count(DISTINCT text) AS texts FROM documents GROUP BY source),
common AS (
  SELECT source, line FROM plain JOIN hosts USING (source) WHERE line <> ''
  GROUP BY source, line, texts HAVING count(DISTINCT text) > 10 AND count(DISTINCT text) > 0.01 * texts),
lost AS (SELECT doc_id, CAST(sum(len(string_split(line, ' '))) AS BIGINT) AS n FROM plain JOIN common USING (source, line) GROUP BY doc_id),
figures AS (
  SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, coalesce(lost.n, 0) AS removed_words
  FROM base LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND removed_words <= 0.5 * n_words AS kept
FROM figures
"""


def op10_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.find(documents(spark, sf_dir))
    listed = lambda column, kind: F.transform(column, lambda s: F.concat_ws(":", F.lit(kind), s.start, s.end))
    base = F.concat(*[listed(F.col(kind), kind) for kind in pii.KINDS])
    return rows.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, F.transform("added", lambda s: F.concat_ws(":", F.concat(F.lit("like_"), s.kind), s.start, s.end))), ",").alias("spans"),
    )


def op11_block_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.judged(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_edit_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audited(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_least_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 2048)


def queries() -> dict:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_recurrent_toxicity": op1_recurrent_toxicity,
        "op2_multi_order_jaccard": op2_multi_order_jaccard,
        "op3_block_max_wand": op3_block_max_wand,
        "op4_token_files": op4_token_files,
        "op5_interval_expansion": op5_interval_expansion,
        "op6_secret_ledger": op6_secret_ledger,
        "op7_stratified_shards": op7_stratified_shards,
        "op8_swap_packing": op8_swap_packing,
        "op9_line_frequency": op9_line_frequency,
        "op10_candidate_boosting": op10_candidate_boosting,
        "op11_block_norms": op11_block_norms,
        "op12_edit_transducer": op12_edit_transducer,
        "op13_least_squares_packing": op13_least_squares_packing,
    }


OP2_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m.y, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS y FROM reach GROUP BY x) m USING (doc_id)
"""


def _either_case(pattern: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in pattern)


def _op6_sql() -> str:
    """Positions are sums of the lengths of the matches and of what lies between them. The first three kinds are the base."""
    keys = _either_case("(password|passwd|secret|token|api_?key)")
    base = [("assign", keys + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32)]
    parts = []
    for pos, (kind, pattern, group, least) in enumerate([*base, *((r.name, r.pattern, r.group, r.least) for r in secrets.MORE_RULES)]):
        q = "'" + pattern.replace("'", "''") + "'"
        parts.append(
            f"SELECT doc_id, {pos} AS pos, '{kind}' AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: {{'a': list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0), 'n': length(m[i]), 'ok': length(g[i]) >= {least}}})) AS x"
            f" FROM (SELECT doc_id, regexp_extract_all(text, {q}, 0) AS m, regexp_extract_all(text, {q}, {group}) AS g, regexp_split_to_array(text, {q}) AS s FROM documents)"
        )
    shown = "kind || ':' || a || ':' || b, ',' ORDER BY a, pos"
    return f"""
WITH spans AS (SELECT doc_id, pos, kind, CAST(x.a AS BIGINT) AS a, CAST(x.a + x.n AS BIGINT) AS b FROM ({' UNION ALL '.join(parts)}) WHERE x.ok),
each AS (SELECT doc_id, string_agg({shown}) AS spans, string_agg({shown}) FILTER (pos < 3) AS base, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ("assign", "access", "hex"))} FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN each USING (doc_id)"""


#: The check sum byte by byte, from a table that the polynomial gives.
OP7_SQL = """
WITH t AS (SELECT list(v ORDER BY i) AS crc FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS v FROM range(256) r(i))),
b AS (SELECT doc_id, source, octet_length(encode(text)) + 16 AS size, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::UBIGINT) AS bytes FROM documents),
c AS (SELECT doc_id, source, CAST(size AS BIGINT) AS size, CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT, bytes), lambda a, x: xor(a >> 8, crc[(xor(a & 255, x) + 1)::BIGINT])), 4294967295::UBIGINT) AS BIGINT) AS text_crc32,
  ('0x' || substr(md5('17:' || doc_id), 1, 15))::UBIGINT AS k FROM b, t),
r AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY k, doc_id) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY source) AS fraction, count(*) OVER () AS total FROM c),
p AS (SELECT *, row_number() OVER (ORDER BY fraction, source, k, doc_id) - 1 AS position FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(position * 40 // total AS INTEGER) AS shard,
  CAST(position - ((position * 40 // total) * total + 39) // 40 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p
"""


def _op11_sql(rounds: int = 3) -> str:
    """Every distance of every round; sums are divided towards minus infinity."""
    whole = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64"
    parts = [
        f"e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings WHERE {whole})",
        "h AS (SELECT x, row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS c FROM e)",
        "c0 AS MATERIALIZED (SELECT c, x FROM h WHERE c < 16)",
    ]
    for k in range(rounds + 1):
        parts.append(f"a{k} AS MATERIALIZED (SELECT r, vec_id, any_value(e.x) AS x, min({{'d': CAST(list_sum(list_transform(list_zip(e.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), 'c': c.c}}) AS m FROM e, c{k} c GROUP BY r, vec_id)")
        if k < rounds:
            places = f"SELECT m.c AS c, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM a{k}, generate_series(1, 64) t(i) GROUP BY ALL"
            parts.append(f"c{k + 1} AS MATERIALIZED (SELECT c.c, coalesce(f.x, c.x) AS x FROM c{k} c LEFT JOIN (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM ({places}) GROUP BY c) f USING (c))")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.c = m.c"""


#: The composition row by row: every state of the grammar with the least cost, string of edits and rows left. States are nothing, system, user, assistant.
OP12_SQL = r"""
WITH RECURSIVE t AS (SELECT list(v ORDER BY i) AS crc FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS v FROM range(256) r(i))),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
summed AS (SELECT given.*, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(name, ''), lambda x: ascii(x)::UBIGINT)), lambda a, x: xor(a >> 8, crc[(xor(a & 255, x) + 1)::BIGINT])), 4294967295::UBIGINT) % 20 AS what FROM given, t),
damaged AS (
  SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
    CASE what WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN what = 3 THEN 2 ELSE 1 END)) AS copy
  FROM summed WHERE what <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS MATERIALIZED (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
facts AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM judged GROUP BY conv_id),
moves(g, role, h) AS (VALUES (0, 'system', 1), (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
before(g, ins, h) AS (VALUES (0, []::VARCHAR[], 0), (0, ['user:'], 2), (0, ['user:', 'assistant:'], 3), (1, [], 1), (1, ['user:'], 2), (1, ['user:', 'assistant:'], 3),
  (2, [], 2), (2, ['assistant:'], 3), (2, ['assistant:', 'user:'], 2), (3, [], 3), (3, ['user:'], 2), (3, ['user:', 'assistant:'], 3)),
arcs AS (
  SELECT b.g, b.ins, 'D' AS edit, NULL AS role, 2 AS cost, b.h FROM before b
  UNION ALL SELECT b.g, b.ins, 'K', m.role, 0, m.h FROM before b JOIN moves m ON m.g = b.h
  UNION ALL SELECT b.g, b.ins, 'R', m.role, 1, m.h FROM before b JOIN moves m ON m.g = b.h WHERE m.role <> 'system'),
ways(conv_id, i, g, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': '', 'out': []::VARCHAR[]} FROM facts
  UNION ALL
  SELECT w.conv_id, any_value(r.i), a.h, min({'cost': w.best.cost + 5 * len(a.ins) + a.cost + CASE WHEN a.edit <> 'D' AND r.fault = 'truncated' THEN 5 ELSE 0 END,
    'audit': w.best.audit || repeat('I', len(a.ins)) || a.edit,
    'out': list_concat(list_concat(w.best.out, a.ins), CASE a.edit WHEN 'D' THEN [] WHEN 'K' THEN [r.role || ':' || r.text] ELSE [a.role || ':' || r.text] END)})
  FROM ways w JOIN judged r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1 JOIN arcs a ON a.g = w.g
  WHERE a.edit = 'D' OR (r.fault NOT IN ('blank', 'duplicate') AND (a.edit = 'R' OR left(a.role, 1) = r.initial))
  GROUP BY w.conv_id, a.h),
tails(g, ins) AS (VALUES (0, []::VARCHAR[]), (1, ['user:', 'assistant:']), (2, ['assistant:']), (3, [])),
ended AS (
  SELECT f.conv_id, min({'cost': w.best.cost + 5 * len(t.ins), 'audit': w.best.audit || repeat('I', len(t.ins)), 'out': list_concat(w.best.out, t.ins)}) AS best
  FROM facts f JOIN ways w ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.i = f.n JOIN tails t ON t.g = w.g GROUP BY f.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(e.best.cost, 0) AS cost, coalesce(e.best.audit, '') AS audit, sha256(coalesce(array_to_string(e.best.out, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def oracle_sql() -> dict:
    return {"op11_block_norms": _op11_sql(), "op12_edit_transducer": OP12_SQL, "op7_stratified_shards": OP7_SQL, "op2_multi_order_jaccard": OP2_SQL, "op6_secret_ledger": _op6_sql(), "op9_line_frequency": OP9_SQL}
