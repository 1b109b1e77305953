"""The registered queries of this subpackage, next to the SQL they equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontamination,
    licences,
    mixing,
    neighbours,
    packing,
    ppm,
    prefixes,
    quality,
    repair,
    simhash,
    tokens,
    warc,
    wrappers,
)
from tidemark.llm.common import materialise, table, temporary

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


SQL_QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM documents),
windows AS (
  SELECT r, i, md5(array_to_string(w[i:i + 7], ' ')) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) > 8)),
again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, sum(least(8, i - before)) AS n
  FROM (SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), i - 8) AS before FROM again) GROUP BY r),
good AS (
  SELECT r, list_filter(lines, lambda x: NOT (
      regexp_matches(x, {_quoted(quality.BOILERPLATE)}) OR regexp_matches(x, {_quoted(quality.NAVIGATION)})
      OR length(regexp_replace(x, '[^#*$%&|<>]+', '', 'g')) * 100
         > length(regexp_replace(x, '[ \t\n\x0B\f\r]+', '', 'g')) * {quality.MAX_SYMBOL_PERCENT}
      OR regexp_matches(x, {_quoted(quality.SHOUTING)}) OR NOT regexp_matches(x, {_quoted(quality.SENTENCE_END)}))) AS good
  FROM d),
figures AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(array_to_string(w, ''), '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(good) AS BIGINT) AS n_lines_removed,
    CAST(length(array_to_string(w, ''))
      - length(regexp_replace(array_to_string(good, ''), '[ \t\n\x0B\f\r]+', '', 'g')) AS BIGINT) AS lost_chars
  FROM d JOIN good USING (r) LEFT JOIN covered USING (r))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
    AND NOT (100 * lost_chars > {quality.MAX_LOST_PERCENT} * word_chars) AS kept
FROM figures
"""


@query(SQL_QUALITY)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = (
        "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_lines_removed lost_chars base_failed kept"
    ).split()
    return quality.judge(table(spark, sf_dir, "documents")).select(*columns)


@query()
def op10_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


#: shares of tokens for the domains that the labels name
TARGETS = {"clean": 0.85, "low": 0.12, "toxic": 0.03}


@query()
def op1_mixing_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mixing.mix(docs, mixing.domains_of(labels), TARGETS, carry=["doc_id"])


@query()
def op4_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query()
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs).drop("text")


@query()
def op9_partial_matching_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_held_out(table(spark, sf_dir, "documents"))


@query()
def op6_archives_by_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


@query()
def op7_pivot_permutation_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


@query()
def op5_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


@query()
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licenses(table(spark, sf_dir, "documents")).withColumn("coverage", F.round("coverage", 6))


def _crc32(text: str) -> str:
    """The CRC-32 of an ASCII text, byte by byte and bit by bit."""
    bits = "list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), xor(a, b))"
    letters = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(4294967295, list_reduce({letters}, lambda a, b: {bits}, CAST(4294967295 AS BIGINT)))"


SQL_PREFIXES = rf"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (SELECT *, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.s[1:c.h], []), c.s[c.h + 1:]) AS s
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
paths AS (
  SELECT conv_id, d, s[1:d] AS p, len(s) = d AS ends FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0
      ELSE (count(*) - 1) * len(list_filter(regexp_split_to_array(p[d].t, '[ \t\n\x0B\f\r]+'), lambda x: x <> '')) END AS saved
  FROM paths GROUP BY p, d),
inner_nodes AS (SELECT DISTINCT p[1:d - 1] AS p FROM nodes WHERE d > 0),
kin AS (
  SELECT p[1:a] AS p, a AS d, count(*) FILTER (d = a + 1) AS n_children, count(*) FILTER (leaf) AS n_leaves,
    CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM (SELECT n.p, d, saved, i.p IS NULL AS leaf, unnest(range(0, d + 1)) AS a FROM nodes n LEFT JOIN inner_nodes i ON i.p = n.p)
  GROUP BY ALL)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, k.n_children, k.n_leaves, k.saved_tokens, n.ends_sha256
FROM nodes n JOIN kin k ON k.p = n.p LEFT JOIN nodes u ON n.d > 0 AND u.p = n.p[1:n.d - 1]
"""


@query(SQL_PREFIXES)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = prefixes.sequences(table(spark, sf_dir, "conversations"))
    return prefixes.prefix_nodes(prefixes.with_shared_openings(materialise(convs, "conversation-ids")))


SQL_CONTAMINATION = rf"""
WITH w AS (
  SELECT row_number() OVER () AS r, NULL AS item_id, doc_id, text, true AS doc FROM documents
  UNION ALL SELECT row_number() OVER (), CAST(item_id AS VARCHAR), NULL, text, false FROM benchmark),
words AS (
  SELECT * EXCLUDE (text), list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS l FROM w),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(l[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, l, n, unnest(range(1, len(l) - n + 2)) AS i
    FROM (SELECT item_id, l, least(len(l), {decontamination.SPAN}) AS n FROM words WHERE NOT doc AND len(l) > 0))),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT r, n, i, array_to_string(l[i:i + n - 1], ' ') AS g
  FROM (SELECT r, l, n, unnest(range(1, len(l) - n + 2)) AS i FROM words, sizes WHERE doc AND len(l) >= n)),
met AS (SELECT r, i, n, item_id FROM places JOIN windows USING (n, g)),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT r, i, n FROM met)) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (r) LEFT JOIN items USING (r) WHERE doc
"""


@query(SQL_CONTAMINATION)
def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _sql_step() -> str:
    """The states of the grammar after a turn, from those before it: the least (cost, audit) of each.

    b is the beginning, s stands behind a leading s, u behind a user and a behind an assistant.
    """

    def least(*found: str) -> str:
        return f"list_min([{', '.join(found)}])"

    def then(state: str, cost: str, letter: str) -> str:
        return f"{{'c': {state}.c + {cost}, 'e': {state}.e || {letter}}}"

    def meets(state: str, letter: str) -> str:
        met = f"CASE WHEN t.i = '{letter}' THEN 0 ELSE 3 END"
        return then(state, f"t.x + ({met}) + CASE WHEN t.q THEN 1000000000 ELSE 0 END", f"CASE WHEN t.i = '{letter}' THEN 'K' ELSE 'R' END")

    only_s = then("z.b", "t.x + CASE WHEN t.q OR t.i <> 's' THEN 1000000000 ELSE 0 END", "'K'")
    gone = {x: then(f"z.{x}", "4", "'D'") for x in "bsua"}
    met = (
        f"{{'b': {gone['b']}, 's': {least(gone['s'], only_s)}, "
        f"'u': {least(gone['u'], meets('z.b', 'u'), meets('z.s', 'u'), meets('z.a', 'u'))}, 'a': {least(gone['a'], meets('z.u', 'a'))}}}"
    )

    # letters may be inserted: u at the beginning, behind s and behind a, then a behind u, then u again
    def inserted(x: str) -> str:
        u = least("y.u", *[then(f"y.{k}", "3", "'I'") for k in "bsa"])
        return f"list_transform([{x}], lambda y: {{'b': y.b, 's': y.s, 'u': {u}, 'a': {least('y.a', then('y.u', '3', chr(39) + 'I' + chr(39)))}}})[1]"

    return inserted(inserted(met))


def _sql_repair() -> str:
    far = "{'c': 1000000000, 'e': ''}"
    none = "{'c': 0, 'e': ''}"
    begin = f"{{'b': {none}, 's': {far}, 'u': {{'c': 3, 'e': 'I'}}, 'a': {{'c': 6, 'e': 'II'}}}}"
    code = _crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")
    return rf"""
WITH hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {code} % 20 AS k FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS again
  FROM hashed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS p FROM damaged),
judged AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS seen,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY p), 1) || left(role, 1) AS pair FROM placed),
faults AS (
  SELECT *, CASE WHEN shown = '' THEN 'b' WHEN seen THEN 'd' WHEN right(shown, 1) IN ('.', '!', '?') THEN '' ELSE 't' END AS f FROM judged),
whole AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank,
    count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, list(role ORDER BY p) AS roles, list(text ORDER BY p) AS texts,
    list_reduce(list({{'i': left(role, 1), 'q': f IN ('b', 'd'), 'x': CASE WHEN f = 't' THEN 3 ELSE 0 END}} ORDER BY p),
      lambda z, t: {_sql_step()}, {begin}) AS z
  FROM faults GROUP BY conv_id),
best AS (SELECT *, list_min([z.b, z.a]) AS best FROM whole),
-- the edits: which turn each takes and which place it fills
edits AS (
  SELECT conv_id, roles, texts, i, best.e[i] AS e, length(replace(best.e, 'D', '')) % 2 AS odd,
    length(replace(best.e[1:i], 'I', '')) AS turn, length(replace(best.e[1:i], 'D', '')) AS place
  FROM (SELECT *, unnest(range(1, length(best.e) + 1)) AS i FROM best)),
repaired AS (
  SELECT conv_id, string_agg(
      CASE WHEN e = 'K' THEN roles[turn] WHEN (place - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
      || ':' || CASE WHEN e = 'I' THEN '' ELSE texts[turn] END, chr(10) ORDER BY i) AS t
  FROM edits WHERE e <> 'D' GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
  coalesce(best.e, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query(_sql_repair())
def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    (there,) = temporary("there")
    found = repair.repair(repair.damage(table(spark, sf_dir, "conversations"), there), there)
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return found.withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n"), 256)).drop("repaired")
