"""Registered queries of the training-data operators, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from churnspark.llm import (
    bayes_join, chat, decontaminate, licenses, mixing, repair, resampling, sharding, shared_bytes, substrings, token_counts, toxicity, voronoi,
)
from churnspark.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(table(spark, sf_dir, "documents"))


SQL["op6_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
starts AS (SELECT doc_id, unnest(range(len(words) - 19)) AS s, words FROM w WHERE len(words) >= 20),
win AS (SELECT doc_id, s, array_to_string(words[s + 1 : s + 20], ' ') AS key FROM starts),
rep AS (SELECT doc_id, s FROM win QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, s + unnest(range(20)) AS i FROM rep),
kept AS (SELECT doc_id, unnest(range(len(words))) AS i, unnest(words) AS word FROM w)
SELECT w.doc_id, CAST(len(any_value(w.words)) AS BIGINT) AS n_words, count(g.i) AS n_removed,
  sha256(coalesce(string_agg(k.word, ' ' ORDER BY k.i) FILTER (WHERE g.i IS NULL), '')) AS kept_sha256
FROM w LEFT JOIN kept k USING (doc_id) LEFT JOIN gone g ON g.doc_id = k.doc_id AND g.i = k.i GROUP BY w.doc_id"""


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(table(spark, sf_dir, "documents"))


@query
def op2_voronoi_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.digest(table(spark, sf_dir, "embeddings"))


SQL["op2_voronoi_knn_join"] = """
WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"coalesce(regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
SQL["op3_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS.format('text')} AS words FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(words), 13) AS n,
    array_to_string(words[s + 1 : s + least(len(words), 13)], ' ') AS key
  FROM (SELECT *, unnest(range(greatest(1, len(words) - 12))) AS s FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
starts AS (SELECT doc_id, n, unnest(range(len(words) - n + 1)) AS s, words FROM d, sizes WHERE len(words) >= n),
hits AS (SELECT x.doc_id, x.s, x.n, win.item_id
  FROM (SELECT doc_id, n, s, array_to_string(words[s + 1 : s + n], ' ') AS key FROM starts) x
  JOIN win ON win.n = x.n AND win.key = x.key),
hit_words AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, s + unnest(range(n)) AS i FROM hits) GROUP BY 1),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


@query
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_bytes.digest(table(spark, sf_dir, "documents"))


SQL["op4_suffix_array_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, unnest(range(length(h) // 2 - 49)) AS s, h FROM d WHERE length(h) >= 100),
win AS (SELECT doc_id, s, md5(substr(h, 2 * s + 1, 100)) AS key FROM starts),
rep AS (SELECT doc_id, s FROM win QUALIFY doc_id > min(doc_id) OVER (PARTITION BY key)),
ordered AS (SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS gap FROM rep),
numbered AS (SELECT doc_id, s, sum(CASE WHEN gap IS NULL OR gap > 50 THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id ORDER BY s) AS span FROM ordered),
spans AS (SELECT doc_id, span, min(s) AS b, max(s) + 50 AS e FROM numbered GROUP BY doc_id, span),
kept AS (SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS after FROM spans),
cut AS (SELECT doc_id, count(*) AS n_spans, sum(e - b) AS n_removed, max(e) AS last,
  string_agg(substr(h, 2 * after + 1, 2 * (b - after)), '' ORDER BY b) AS head FROM kept JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""


@query
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bayes_join.digest(table(spark, sf_dir, "documents"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(table(spark, sf_dir, "conversations"))


@query
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))



SQL["op10_source_mixing"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid
  FROM d GROUP BY source),
s1 AS (SELECT *, CAST((sid - 1) % 3 + 1 AS BIGINT) AS w FROM s0),
s2 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / CAST(sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM s1
  WINDOW o AS (ORDER BY CAST(3 * source_size AS DOUBLE) / w, sid)),
s3 AS (SELECT *, (SELECT level FROM s2 WHERE 3 * source_size >= level * w ORDER BY CAST(3 * source_size AS DOUBLE) / w, sid LIMIT 1) AS share
  FROM s2),
s4 AS (SELECT sid, source, source_size, least(CAST(3 * source_size AS DOUBLE),
  CASE WHEN 3 * source_size < level * w THEN CAST(3 * source_size AS DOUBLE) ELSE w * share END) AS target FROM s3),
s5 AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS f FROM s4),
s AS (SELECT *, CAST(floor(f) AS BIGINT) AS whole, target - floor(f) * source_size AS open, f - floor(f) AS p FROM s5),
x AS (SELECT d.doc_id, d.size, s.* EXCLUDE (source), CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '#42'), 1, 13) AS BIGINT) AS DOUBLE)
  / 4503599627370496 AS u FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
r0 AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds FROM x),
r AS (SELECT *, odds / (1 + odds) AS r FROM r0),
turns AS (SELECT sid, doc_id, size, row_number() OVER (PARTITION BY sid ORDER BY copy, r, CAST(doc_id AS VARCHAR)) AS i
  FROM r, range(3) c(copy) WHERE p > 0 AND size > 0 AND whole + copy < 3),
walk AS (SELECT sid, CAST(0 AS BIGINT) AS i, open AS gap, CAST(NULL AS BIGINT) AS doc_id, FALSE AS fits FROM s WHERE p > 0
  UNION ALL
  SELECT t.sid, t.i, CASE WHEN t.size <= gap THEN gap - t.size ELSE gap END, t.doc_id, t.size <= gap
  FROM walk JOIN turns t ON t.sid = walk.sid AND t.i = walk.i + 1),
extra AS (SELECT doc_id, count(*) AS m FROM walk WHERE fits GROUP BY doc_id)
SELECT doc_id, size, source_size, target, CAST(size * (whole + coalesce(m, 0)) AS BIGINT) AS taken FROM r LEFT JOIN extra USING (doc_id)"""


# CRC-32 in SQL: the byte table by eight steps of the polynomial, then byte after byte. {0}: a text without nulls.
_CRC_TABLE = """crc_table AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([CAST(i AS BIGINT)] || [0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))"""
_CRC = """xor(4294967295, list_reduce([4294967295] || [CAST('0x' || p AS BIGINT) FOR p IN regexp_extract_all(hex(encode({0})), '..')],
  lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])))"""


def _fraction(key: str, seed: str) -> str:
    return f"(CAST(CAST('0x' || substr(md5({key} || '#{seed}'), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496)"


@query
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


# Logarithm of the weight of k marked ones.
_LOG_WEIGHT = "-(lgamma({0} + 1) + lgamma(marked - {0} + 1) + lgamma(drawn - {0} + 1) + lgamma(total - marked - drawn + {0} + 1))"
SQL["op12_sharding"] = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, {_CRC.format("coalesce(text, '')")} AS text_crc32
  FROM documents, crc_table),
named AS (SELECT *, concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), 'null'), size, text_crc32,
  row_number() OVER (PARTITION BY doc_id, size, text_crc32) - 1) AS name FROM d),
p AS (SELECT count(*) AS n, CAST(greatest(32, 2 ** ceil(log2(greatest(1, ceil(count(*) / 1048576e0))))) AS BIGINT) AS parts FROM d),
rows AS (SELECT named.*, parts, CAST(floor({_fraction('name', 'shuffle part')} * parts) AS BIGINT) AS part,
  {_fraction('name', 'shuffle first')} AS first, {_fraction('name', 'shuffle second')} AS second FROM named, p),
nodes AS (SELECT level, part // (parts >> level) AS node, count(*) AS n
  FROM rows, range(32) l(level) WHERE 1 << level <= parts GROUP BY ALL),
tree AS (SELECT 0 AS level, CAST(0 AS BIGINT) AS node, 0 AS s, [CAST(n // 16 AS BIGINT) + CAST(i < n % 16 AS BIGINT) FOR i IN range(16)] AS room,
    CAST([] AS BIGINT[]) AS got FROM p
  UNION ALL
  SELECT CASE WHEN s = 15 THEN level + 1 ELSE level END, CASE WHEN s = 15 THEN 2 * node + side ELSE node END, (s + 1) % 16,
    CASE WHEN s < 15 THEN room WHEN side = 0 THEN got || [x] ELSE [a[1] - a[2] FOR a IN list_zip(room, got || [x])] END,
    CASE WHEN s < 15 THEN got || [x] ELSE [] END
  FROM (SELECT *, CAST(ks[1 + least(len(ks) - 1, len([i FOR i IN range(1, len(ws) + 1) IF list_sum(ws[1:i]) <= u * list_sum(ws)]))] AS BIGINT) AS x
    FROM (SELECT *, [CASE WHEN k BETWEEN low AND high THEN exp({_LOG_WEIGHT.format('k')} - ({_LOG_WEIGHT.format('mode')})) ELSE 0 END FOR k IN ks] AS ws
      FROM (SELECT *, [CAST(mode AS DOUBLE)] || flatten([[mode + i, mode - i] FOR i IN range(1, CAST(high - low AS BIGINT) + 1)]) AS ks
        FROM (SELECT *, greatest(low, least(high, floor((drawn + 1) * (marked + 1) / (total + 2)))) AS mode,
            {_fraction("(level || ':' || node || ':' || s)", 'shuffle')} AS u
          FROM (SELECT *, greatest(0e0, drawn + marked - total) AS low, least(marked, drawn) AS high
            FROM (SELECT tree.*, CAST(list_sum(room[s + 1:]) AS DOUBLE) AS total, CAST(room[s + 1] AS DOUBLE) AS marked,
                CAST(coalesce(c.n, 0) - coalesce(list_sum(got), 0) AS DOUBLE) AS drawn
              FROM tree LEFT JOIN nodes c ON c.level = tree.level + 1 AND c.node = 2 * tree.node
              WHERE 1 << tree.level < (SELECT parts FROM p))))))), range(2) r(side)
  WHERE s = 15 OR side = 0),
counts AS (SELECT node AS part, [CAST(list_sum(room[1:i]) AS BIGINT) FOR i IN range(1, 17)] AS until FROM tree
  WHERE s = 0 AND 1 << level = (SELECT parts FROM p)),
dealt AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY first, name) AS place FROM rows)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY second, name) - 1 AS slot,
  CAST(NULL AS INT) AS grown_shard
FROM (SELECT dealt.*, CAST(len([c FOR c IN until IF c < place]) AS INT) AS shard FROM dealt JOIN counts USING (part))"""


@query
def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op13_target_resampling"] = f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, {_WORDS.format('text')} AS words FROM documents),
b AS (SELECT unnest({_WORDS.format('text')}) AS word FROM benchmark),
w AS (SELECT doc_id, unnest(words) AS word FROM d),
codes AS (SELECT word, {_CRC.format('word')} % 10000 AS bucket FROM (SELECT word FROM w UNION SELECT word FROM b), crc_table),
s AS (SELECT bucket, count(*) AS s FROM w JOIN codes USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN codes USING (word) GROUP BY bucket),
gains AS (SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM w) + 10000)) /
    (CAST(s + 1 AS DOUBLE) * ((SELECT count(*) FROM b) + 10000)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT doc_id, sum(gain) AS weight FROM w JOIN codes USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5e0) / 4294967296e0))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM ranked) * 10 // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)"""


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digest(table(spark, sf_dir, "conversations"))


def _edit(state: str, cost: str, letter: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}}"


def _least(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


# Forward, the cheapest and then least edits to each state: s0 nothing yet, s1 after system, s2 after user, s3 after assistant;
# u and e are s2 and s3 after insertions. A way that does not exist costs 2^40.
_BEFORE_USER = ("s0", "s1", "e")
_NO = "{'c': CAST(1099511627776 AS BIGINT), 'a': ''}"
_INSERTED = f"""(SELECT *, {_least('s3', _edit('u', '2', 'I'))} AS e FROM (SELECT *,
  {_least('s2', *[_edit(s, '2', 'I') for s in ('s0', 's1', 's3')])} AS u FROM way))"""


def _kept(state: str, initial: str) -> str:
    return f"CASE WHEN keeps AND initial = '{initial}' THEN {_edit(state, 'extra', 'K')} ELSE {_NO} END"


def _reroled(state: str) -> str:
    return f"CASE WHEN keeps THEN {_edit(state, '2 + extra', 'R')} ELSE {_NO} END"


SQL["op11_conversation_repair"] = f"""
WITH RECURSIVE {_CRC_TABLE},
kinds AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_CRC.format("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind FROM conversations, crc_table),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM kinds WHERE kind <> 0),
lined AS (SELECT *, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS bare, left(role, 1) AS initial, row_number() OVER o AS i,
  lag(left(role, 1)) OVER o AS previous
  FROM damaged WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(concat_ws(':', length(role), role, text)))),
rows AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM lined),
facts AS (SELECT *, coalesce(fault, '') NOT IN ('blank', 'duplicate') AS keeps, CAST(coalesce(fault, '') = 'truncated' AS BIGINT) AS extra FROM rows),
way AS (SELECT conv_id AS conv, CAST(0 AS BIGINT) AS done, {{'c': CAST(0 AS BIGINT), 'a': ''}} AS s0, {_NO} AS s1, {_NO} AS s2, {_NO} AS s3
    FROM (SELECT DISTINCT conv_id FROM rows)
  UNION ALL
  SELECT conv, i, {_edit('s0', '3', 'D')}, {_least(_edit('s1', '3', 'D'), _kept('s0', 's'))},
    {_least(_edit('u', '3', 'D'), *[_kept(s, 'u') for s in _BEFORE_USER], *[_reroled(s) for s in _BEFORE_USER])},
    {_least(_edit('e', '3', 'D'), _kept('u', 'a'), _reroled('u'))}
  FROM {_INSERTED} JOIN facts ON conv IS NOT DISTINCT FROM conv_id AND i = done + 1),
best AS (SELECT conv, {_least('s0', 'e')} AS best FROM {_INSERTED} QUALIFY row_number() OVER (PARTITION BY conv ORDER BY done DESC) = 1),
letters AS (SELECT conv, unnest(range(1, length(best.a) + 1)) AS p, best.a AS audit FROM best),
steps AS (SELECT conv, p, audit[p] AS letter, count(*) FILTER (audit[p] <> 'I') OVER o AS i, count(*) FILTER (audit[p] <> 'D') OVER o AS j,
  count(*) FILTER (audit[p] <> 'D') OVER (PARTITION BY conv) % 2 AS odd FROM letters WINDOW o AS (PARTITION BY conv ORDER BY p)),
bodies AS (SELECT conv, string_agg(CASE WHEN letter = 'K' THEN role WHEN (j - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS body
  FROM steps LEFT JOIN facts ON conv IS NOT DISTINCT FROM conv_id AND facts.i = steps.i AND letter <> 'I' WHERE letter <> 'D' GROUP BY conv),
counts AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (i > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM facts GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts ON o.conv_id IS NOT DISTINCT FROM counts.conv_id
LEFT JOIN best ON o.conv_id IS NOT DISTINCT FROM best.conv LEFT JOIN bodies ON o.conv_id IS NOT DISTINCT FROM bodies.conv"""
