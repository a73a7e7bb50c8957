"""The registered queries of the training-data operators: each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import (
    decontaminate,
    html_text,
    jaccard_join,
    licenses,
    merkle,
    mixing,
    mixing_lm,
    pii,
    quality_rules,
    suffix_dedup,
    token_alignment,
    token_counts,
    toxicity,
)
from assay.llm.common import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def registered(name: str):
    def add(query):
        REGISTRY[name] = query
        return query

    return add


@registered("op1_decontamination")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    items = F.col("contamination.hit_items")
    return found.select(
        "doc_id",
        "contamination.n_words",
        "contamination.n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        "contamination.contaminated",
    )


ORACLE["op1_decontamination"] = r"""
WITH fold AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), u, l),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, fold
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), u, l),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, fold
), at_item AS (
  SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
  FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM at_item
), at_doc AS (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
  FROM d, (SELECT DISTINCT k FROM windows)
), grams AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM at_doc
), found AS (
  SELECT doc_id, i, k, item_id FROM grams JOIN windows USING (k, g)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""


@registered("op2_license_scan")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licences(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *[f"licence.{c}" for c in ("n_words", "n_base", "first_word", "last_word")],
        F.array_join("licence.base_labels", ",").alias("base_labels"),
        F.array_join("licence.labels", ",").alias("labels"),
        "licence.score",
    )


@registered("op9_token_counts")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


@registered("op6_quality_rules")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    rules = quality_rules.fit_rules(documents, table(spark, folder, "labels"))
    return quality_rules.apply_rules(documents, rules).select(
        "doc_id",
        *[
            f"quality_rules.{c}"
            for c in (
                "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "base_failed", "kept", "rule",
            )
        ],
    )


@registered("op10_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = toxicity.fit_model(documents, table(spark, folder, "labels"))
    return toxicity.score_toxicity(documents, model).select("doc_id", "toxicity.*")


@registered("op4_pii")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.with_spans(table(spark, folder, "documents").select("doc_id", "text"))
    found = found.withColumn("base", F.filter("pii", lambda s: s["base"]))
    base = F.col("base")

    def number(kind: str):
        of_kind = F.filter(base, lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    counted = [number(kind) for kind in ("email", "ip", "card", "phone")]
    return found.select(
        "doc_id",
        *counted,
        F.sha2(pii.spelled(base), 256).alias("base_sha256"),
        pii.spelled(F.col("pii")).alias("spans"),
    )


def labelled_domains(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").select(
        "doc_id", mixing.label_domain(F.col("quality"), F.col("toxic")).alias("domain")
    )


@registered("op7_source_mixing")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(
        table(spark, folder, "documents"),
        labelled_domains(spark, folder),
        keep=("doc_id", "source"),
    )
    return mixed.select(
        "doc_id",
        "source",
        F.col("mixing.tokens").alias("n_tokens"),
        *[F.col(f"mixing.posterior.{d}").alias(f"p_{d}") for d in mixing.TARGETS],
        "mixing.rate",
    )


@registered("op5_ngram_jaccard_join")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join_similar(table(spark, folder, "documents"))


@registered("op8_suffix_array_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.find_repeats(table(spark, folder, "documents")).drop("removed_runs")


@registered("op3_lm_scoring")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return mixing_lm.score_texts(table(spark, folder, "documents"))


@registered("op11_merkle_manifest")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))


ORACLE["op11_merkle_manifest"] = r"""
WITH RECURSIVE crc_table AS (
  SELECT n, 0 AS k, n AS c FROM range(256) t(n)
  UNION ALL
  SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM crc_table WHERE k < 8
), crc_row AS (
  SELECT list(c ORDER BY n) AS t FROM crc_table WHERE k = 8
), crc AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS i, 4294967295 AS c FROM (SELECT DISTINCT doc_id FROM documents)
  UNION ALL
  SELECT doc_id, s, i + 1, xor(t[(xor(c, ord(s[i + 1])) & 255) + 1], c >> 8) FROM crc, crc_row WHERE i < len(s)
), picked AS (
  SELECT doc_id FROM crc WHERE i = len(s) AND xor(c, 4294967295) % 5 = 0
), fields AS (
  SELECT d.doc_id, source, text, p.doc_id IS NOT NULL AS tampered,
    coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM documents d LEFT JOIN picked p ON p.doc_id = d.doc_id
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN tampered THEN sha256(head || coalesce(strlen(text) || ':' ||
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS changed
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves
), nodes AS (
  SELECT source, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM placed
  UNION ALL
  SELECT source, level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 15) // 16)
  FROM nodes WHERE n > 1 GROUP BY source, level, i // 16
), subroots AS (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, i, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 15) // 16)
  FROM tops WHERE n > 1 GROUP BY level, i // 16
), runs AS (
  SELECT source, level, i // 16 AS run, list(h ORDER BY i) AS hs FROM nodes WHERE n > 1 GROUP BY 1, 2, 3
), top_runs AS (
  SELECT level, i // 16 AS run, list(h ORDER BY i) AS hs FROM tops WHERE n > 1 GROUP BY 1, 2
), walk AS (
  SELECT p.doc_id, p.leaf, s.h AS subroot, p.source, s.i AS top, CAST(0 AS BIGINT) AS level, FALSE AS over_sources,
    p.i, coalesce(changed, leaf) AS h, '' AS siblings, FALSE AS done
  FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
  UNION ALL
  SELECT w.doc_id, w.leaf, w.subroot, w.source, w.top,
    CASE WHEN r.hs IS NULL AND NOT over_sources THEN 0 ELSE w.level + 1 END,
    over_sources OR r.hs IS NULL,
    CASE WHEN over_sources THEN w.i // 16 WHEN r.hs IS NULL THEN w.top ELSE w.i // 16 END,
    CASE WHEN coalesce(r.hs, t.hs) IS NULL THEN w.h
      ELSE sha256(array_to_string(coalesce(r.hs, t.hs)[:w.i % 16], '') || w.h
        || array_to_string(coalesce(r.hs, t.hs)[w.i % 16 + 2:], '')) END,
    CASE WHEN coalesce(r.hs, t.hs) IS NULL THEN w.siblings
      ELSE w.siblings || array_to_string(coalesce(r.hs, t.hs)[:w.i % 16], '')
        || array_to_string(coalesce(r.hs, t.hs)[w.i % 16 + 2:], '') END,
    over_sources AND t.hs IS NULL
  FROM walk w
  LEFT JOIN runs r ON NOT over_sources AND r.source IS NOT DISTINCT FROM w.source AND r.level = w.level AND r.run = w.i // 16
  LEFT JOIN top_runs t ON over_sources AND t.level = w.level AND t.run = w.i // 16
  WHERE NOT done
)
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, h AS folded_root, h = root AS verified
FROM walk, (SELECT h AS root FROM tops WHERE n = 1) WHERE done
"""


@registered("op12_html_text")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return html_text.extract_text(pages, html_text.fit_model(pages))


@registered("op13_token_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align_tokens(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


ORACLE["op5_ngram_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
  UNION SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * i >= 75 * (p.n + q.n - i)
), e AS (
  SELECT x AS a, y AS b FROM l UNION SELECT y, x FROM l
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""
