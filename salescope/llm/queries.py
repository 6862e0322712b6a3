"""Registered queries of the corpus operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm import columnwise, infill, katz, language, licenses, merkle, packing, pieces, pii, simhash, subspaces, token_streams, windows, winnowing
from salescope.session import scratch_path

QUERIES: dict = {}
SQL: dict[str, str] = {}


def registered(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registered
def op1_token_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-streams")
    index = token_streams.write_streams(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder, end_id=2)
    found = token_streams.read_checksums(token_streams.with_starts(index), folder)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32", "file", "first")


@registered
def op4_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = pieces.encoded_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 4096, end_id=1)
    return packing.pack(cut, "length", 4096, ["doc_id", "piece"])


@registered
def op10_rabin_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.removed_words(table(spark, sf_dir, "documents"), 35).drop("intervals")


SQL["op10_rabin_karp"] = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
f AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY k) > 1),
s AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 35, true) AS new FROM f),
m AS (SELECT doc_id, min(i) AS a, max(i) + 35 AS b FROM (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM s) GROUP BY doc_id, run),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS before FROM m),
c AS (SELECT doc_id, sum(b - a) AS gone, max(b) AS last, flatten(list(w[before:a - 1] ORDER BY a)) AS kept FROM p JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_concat(kept, w[last:]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""


@registered
def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


SQL["op5_winnowing"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT *, least(len(w), 10) AS n FROM b WHERE len(w) > 0))),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, dw.n, i FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
h AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""


@registered
def op2_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@registered
def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(language.fold(F.col("doc_id"), 4) == 2, F.lit(False))
    found = language.identify(docs.select("doc_id", "text"), docs.where(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@registered
def op9_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined(pii.ordered(F.col("base"))), 256).alias("base_sha256"),
                        pii.joined(pii.ordered(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))


@registered
def op7_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspaces.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)


SQL["op7_subspace_join"] = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95::DOUBLE),
reach AS (SELECT vec_id AS n, vec_id AS m FROM v UNION SELECT r.n, l.b FROM reach r JOIN links l ON l.a = r.m),
least AS (SELECT n AS vec_id, min(m) AS component_id FROM reach GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, component_id = vec_id AS kept FROM least
"""


@registered
def op6_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(language.fold(F.col("doc_id"), 5) == 1, F.lit(False))
    found = katz.score(table(spark, sf_dir, "documents").select("doc_id", "text", (~held_out).alias("train")))
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@registered
def op8_columnwise_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columnwise.removed_bytes(table(spark, sf_dir, "documents"), 100).drop("spans")


SQL["op8_columnwise_order"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
e AS (SELECT doc_id, n, j, substr(x, 2000 * j + 1, 2198) AS y FROM (SELECT *, unnest(range((n + 900) // 1000)) AS j FROM d WHERE n >= 100)),
g AS (SELECT doc_id, 1000 * j + i AS i, md5(substr(y, 2 * i + 1, 200)) AS k FROM (SELECT doc_id, j, y, unnest(range(least(1000, n - 99 - 1000 * j))) AS i FROM e)),
f AS (SELECT doc_id, i FROM g QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
s AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS new FROM f),
m AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM s) GROUP BY doc_id, run),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM m),
c AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS spans, max(b) AS last, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM p JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept || substr(x, 2 * last + 1), x))) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""


@registered
def op11_swar_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.transform(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL["op11_swar_infill"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS g FROM documents),
h AS (SELECT doc_id, t, length(t) AS n, ('0x' || g[1:8])::BIGINT AS h1, ('0x' || g[9:16])::BIGINT AS h2,
        ('0x' || g[17:24])::BIGINT AS h3, ('0x' || g[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM o
"""


@registered
def op12_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.detect(table(spark, sf_dir, "documents"))
    phrases = F.filter("found", lambda d: d["tier"] == "phrase")
    named = lambda of: F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda d: d["label"]))), ",")
    return found.select("doc_id", "n_words", F.size(phrases).cast("long").alias("n_base"),
                        F.array_min(F.transform(phrases, lambda d: d["first"])).alias("first_word"),
                        F.array_max(F.transform(phrases, lambda d: d["first"])).alias("last_word"),
                        named(phrases).alias("base_labels"), named(F.col("found")).alias("labels"),
                        F.coalesce(F.array_max(F.transform("found", lambda d: d["sure"])), F.lit(0.0)).alias("score"),
                        F.size("found").cast("long").alias("n_found"))


@registered
def op13_lag_lead_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = lambda n_chars: [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    leaves = docs.select("doc_id", "lang", merkle.leaf(*fields(F.col("n_chars"))).alias("leaf"),
                         F.when(changed, merkle.leaf(*fields(F.col("n_chars") + 1))).alias("tampered"))
    found = merkle.manifest(leaves, "doc_id", "lang")
    found = found.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


SQL["op13_lag_lead_merkle"] = """
WITH RECURSIVE sized AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS a,
    coalesce(strlen(text) || ':' || text, '-') AS b,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, byte: list_reduce(list_prepend(xor(c, byte), range(8)), lambda k, i: xor(k >> 1, 3988292384 * (k & 1)))),
      4294967295) % 7 = 0 AS hit
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || b) AS leaf,
    sha256(a || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || b) AS changed, coalesce(hit, false) AS hit,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
  FROM sized),
low AS (
  SELECT lang, 0 AS level, i, leaf AS node, n FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (n + 1) // 2 FROM low WHERE n > 1 GROUP BY lang, level, i // 2, n),
subroots AS (
  SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, i, subroot AS node, n FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (n + 1) // 2 FROM high WHERE n > 1 GROUP BY level, i // 2, n),
steps AS (
  SELECT l.doc_id, a.level, coalesce(s.node, '') AS sibling, s.i < a.i AS first
  FROM leaves l JOIN low a ON a.lang IS NOT DISTINCT FROM l.lang AND a.n > 1 AND a.i = l.i >> a.level
  LEFT JOIN low s ON s.lang IS NOT DISTINCT FROM a.lang AND s.level = a.level AND s.i = xor(a.i, 1)
  UNION ALL
  SELECT l.doc_id, 1000 + a.level, coalesce(s.node, ''), s.i < a.i
  FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang JOIN high a ON a.n > 1 AND a.i = r.i >> a.level
  LEFT JOIN high s ON s.level = a.level AND s.i = xor(a.i, 1)),
ways AS (
  SELECT doc_id, sha256(string_agg(sibling, '' ORDER BY level)) AS proof_sha256, count(*) AS steps,
    list(sibling ORDER BY level) AS siblings, list(coalesce(first, false) ORDER BY level) AS firsts
  FROM steps GROUP BY doc_id),
folds AS (
  SELECT l.doc_id, 0 AS k, CASE WHEN hit THEN changed ELSE leaf END AS node FROM leaves l
  UNION ALL
  SELECT f.doc_id, k + 1, sha256(CASE WHEN firsts[k + 1] THEN siblings[k + 1] || node ELSE node || siblings[k + 1] END)
  FROM folds f JOIN ways w ON w.doc_id = f.doc_id WHERE k < steps)
SELECT l.doc_id, l.leaf, r.subroot, t.node AS root, coalesce(w.proof_sha256, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = t.node AS verified
FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang LEFT JOIN ways w ON w.doc_id = l.doc_id
JOIN folds f ON f.doc_id = l.doc_id AND f.k = coalesce(w.steps, 0), (SELECT node FROM high WHERE n = 1) t
"""
