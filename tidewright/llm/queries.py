"""The operators as queries over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from tidewright.llm import (
    byte_repeats,
    centroids,
    chat,
    decontamination,
    language,
    licenses,
    mixing,
    near_duplicates,
    packing,
    prefix_trie,
    quality,
    recompression,
    token_output,
)
from tidewright.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.pareto_mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op2_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = recompression.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op3_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark")).drop("text")
    return found.select(
        "doc_id",
        "n_words",
        decontamination.hit_words("hit_starts", "hit_stops").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        decontamination.items_digest("items").alias("items_sha256"),
        (F.size("hit_starts") > 0).alias("contaminated"),
    )


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_scan(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, learn_from=language.learnable())
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = byte_repeats.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.components(table(spark, sf_dir, "documents"), percent=85)


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query
def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.encoded_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame(
        [(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string"
    )
    return chat.read_back(chat.format_turns(turns.unionByName(added)))


@query
def op11_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

ORACLE["op10_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), learned AS (
  SELECT conv_id, sum(length(text)) AS chars, string_agg(text, '' ORDER BY turn, role, text) AS text
  FROM turns WHERE role = 'assistant' GROUP BY conv_id
)
SELECT t.conv_id, count(*) AS n_turns,
  sha256(string_agg(t.role || chr(10) || t.text || chr(10), '' ORDER BY t.turn, t.role, t.text)) AS turns_sha256,
  CAST(coalesce(any_value(l.chars), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(any_value(l.text), '')) AS loss_sha256,
  CAST(sum(length('### ' || replace(replace(t.role, '\', '\\'), chr(10), '\n') || chr(10)
      || regexp_replace(t.text, '(\\*)(###|</turn>)', '\\\1\2', 'g')
      || chr(10) || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM turns t LEFT JOIN learned l ON l.conv_id = t.conv_id GROUP BY t.conv_id
"""

_TEMPLATE_ROWS = ",\n".join(
    f"('{label}', {words!r})" for label, words in licenses.template_words(licenses.TEMPLATES).items()
)
_NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _places(phrase: str, label: str) -> str:
    words = phrase.split()
    same = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words, 1))
    return f"SELECT doc_id, '{label}' AS label, i FROM d, unnest(range(len(w))) u(i) WHERE {same}"


ORACLE["op4_license_scan"] = rf"""
WITH t(label, tokens) AS (VALUES {_TEMPLATE_ROWS}),
d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS f,
    list_filter(string_split_regex(f, '{_NOT_WORD}'), lambda x: x <> '') AS w
  FROM documents
),
p AS ({" UNION ALL ".join(_places(phrase, label) for phrase, label in licenses.PHRASES.items())}),
base AS (
  SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS found FROM p GROUP BY doc_id
),
b AS (
  SELECT doc_id, list_distinct(string_split_regex(x, '{_NOT_WORD}')) AS tokens
  FROM (SELECT doc_id, unnest(string_split_regex(f, '\n[ \t\r]*\n')) AS x FROM d)
),
m AS (
  SELECT doc_id, label, len(list_intersect(b.tokens, t.tokens)) AS n, len(t.tokens) AS size
  FROM b, t WHERE len(list_intersect(b.tokens, t.tokens)) >= ceil({licenses.THRESHOLD} * len(t.tokens) - 1e-9)
),
best AS (SELECT doc_id, list(DISTINCT label) AS found, max(n / size) AS containment FROM m GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(base.n, 0) AS n_base, lo AS first_word, hi AS last_word,
  coalesce(array_to_string(list_sort(base.found), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(
    list_concat(coalesce(base.found, []), coalesce(best.found, [])))), ','), '') AS labels,
  greatest(CASE WHEN base.n > 0 THEN 1.0 ELSE 0.0 END, coalesce(containment, 0.0))::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id)
"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op3_wu_manber"] = rf"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex({_FOLDED}, '{_NOT_WORD}'), lambda x: x <> '') AS w FROM documents
),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
    list_filter(string_split_regex({_FOLDED}, '{_NOT_WORD}'), lambda x: x <> '') AS w
  FROM benchmark
),
pat AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i + 1:i + least(len(w), 10)], ' ') AS s
  FROM b, unnest(range(len(w) - least(len(w), 10) + 1)) u(i) WHERE len(w) > 0
),
win AS (
  SELECT doc_id, i, n, array_to_string(w[i + 1:i + n], ' ') AS s
  FROM d, (SELECT DISTINCT n FROM pat), unnest(range(len(w) - n + 1)) u(i) WHERE len(w) >= n
),
hit AS (SELECT doc_id, i, win.n, item FROM win JOIN pat ON win.n = pat.n AND win.s = pat.s),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(n)) u(k) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLE["op7_minhash"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex({_FOLDED}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + least(len(w), 5)], ' ') AS s
  FROM d, unnest(range(len(w) - least(len(w), 5) + 1)) u(i) WHERE len(w) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
),
e AS (
  SELECT a, b FROM links JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * shared >= 85 * (na.n + nb.n - shared)
),
reach(a, b) AS (
  SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a
),
c AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id
"""

ORACLE["op2_recompression"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
win AS (
  SELECT doc_id, i, md5_number(array_to_string(w[i + 1:i + 20], ' ')) AS s
  FROM d, unnest(range(len(w) - 19)) u(i) WHERE len(w) >= 20
),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM win
  ) WHERE k > 1
),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, unnest(range(20)) u(k)),
named AS (SELECT doc_id, list(i) AS places FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
  sha256(array_to_string(
    CASE WHEN places IS NULL THEN w
    ELSE list_filter(w, lambda x, i: NOT list_contains(places, i - 1)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN named USING (doc_id)
"""


def _rounds(n: int) -> str:
    """Assignment `a<i>` to the centroids `c<i>`, and the centroids after it."""
    steps = []
    for i in range(n + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, any_value(k.v) AS v, min(CAST(list_sum(list_transform(range(1, 65),
    lambda j: (k.v[j] - c.v[j]) * (k.v[j] - c.v[j]))) AS BIGINT) * 8 + c.c) AS m
  FROM kept k, c{i} c GROUP BY vec_id
)""")
        if i < n:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(any_value(u.v), any_value(c.v)) AS v FROM c{i} c LEFT JOIN (
    SELECT c, list((s - (s % n + n) % n) // n ORDER BY j) AS v FROM (
      SELECT m % 8 AS c, j, CAST(sum(v[j]) AS BIGINT) AS s, count(*) AS n FROM a{i}, unnest(range(1, 65)) u(j) GROUP BY ALL
    ) GROUP BY c
  ) u ON u.c = c.c GROUP BY c.c
)""")
    return ",\n".join(steps)


ORACLE["op12_centroids"] = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v
  FROM (SELECT sha256('{centroids.SEED}:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {centroids.CLUSTERS})
),
{_rounds(centroids.ROUNDS)},
last AS (SELECT vec_id, m % 8 AS cluster, m // 8 AS distance FROM a{centroids.ROUNDS})
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM last JOIN c{centroids.ROUNDS} c ON c.c = cluster
"""

ORACLE["op13_prefix_trie"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
),
o AS (
  SELECT conv_id, list({'role': role, 'text': text}
      ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS turns,
    list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x))),
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))) AS crc
  FROM t GROUP BY conv_id
),
r AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS turns
  FROM (SELECT *, CAST(xor(crc, 4294967295) % 9 AS BIGINT) AS h FROM o) o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 5
),
m AS MATERIALIZED (
  SELECT conv_id, d AS depth, sha256(CAST(to_json(turns[1:d]) AS VARCHAR)) AS name,
    CASE WHEN d > 0 THEN sha256(CAST(to_json(turns[1:d - 1]) AS VARCHAR)) END AS above,
    CASE WHEN d > 0 THEN strlen(turns[d].text) ELSE 0 END AS bytes, d = len(turns) AS ends
  FROM r, unnest(range(len(turns) + 1)) u(d)
),
n AS MATERIALIZED (
  SELECT depth, name, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM m GROUP BY depth, name
),
k AS MATERIALIZED (
  SELECT n.*, p.conv_id AS parent_conv_id, coalesce(c.n_children, 0) AS n_children
  FROM n LEFT JOIN n p ON p.depth = n.depth - 1 AND p.name = n.above
  LEFT JOIN (SELECT depth - 1 AS depth, above, count(*) AS n_children FROM n GROUP BY ALL) c
    ON c.depth = n.depth AND c.above = n.name
),
s AS (
  SELECT m.depth, m.name, count(*) FILTER (WHERE k.n_children = 0) AS n_leaves,
    CAST(sum((k.n_convs - 1) * k.bytes) AS BIGINT) AS saved_tokens
  FROM m JOIN k ON k.conv_id = m.conv_id AND k.depth >= m.depth GROUP BY m.depth, m.name
)
SELECT k.conv_id, k.depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM k JOIN s ON s.depth = k.depth AND s.name = k.name
"""
