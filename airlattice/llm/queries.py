"""The ten operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlattice.llm import budget, covertree, factorise, jaccard, linedup, linerules, maintext, multiindex, pieces, prefixtrie, private, shards, spans
from airlattice.llm.common import ship_package, table

#: Public vocabulary files; a path that every executor can open.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_PAIRS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return make(ship_package(spark), folder.rstrip("/"))

    QUERIES[make.__name__] = run
    return make


@query
def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = maintext.extract_main_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


@query
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join_similar(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links", "text_class", "n_grams")


@query
def op3_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.write_shards(table(spark, folder, "documents"), BYTE_PAIRS)


@query
def op4_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    found = spans.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "deduplicated.n_sentences", "deduplicated.n_removed", "deduplicated.text")


@query
def op5_quality_machine(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "n_chars")
    machine = factorise.train(docs, table(spark, folder, "labels"))
    return factorise.score_quality(docs, machine).select("doc_id", "quality_score.held_out", "quality_score.score", "quality_score.predicted")


@query
def op6_budget_mix(spark: SparkSession, folder: str) -> DataFrame:
    return budget.mix_sources(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "times")


@query
def op7_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = linerules.judge_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[f"rules.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_words", "n_lines")])


@query
def op8_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.encode_pieces(docs, PIECES).select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "same")


@query
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = private.find_personal(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[f"personal.{c}" for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")])


@query
def op10_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return multiindex.nearest(table(spark, folder, "embeddings"))


@query
def op11_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = linedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", F.sha2(F.encode("line_dedup.text", "UTF-8"), 256).alias("kept_sha256"))


ORACLES["op11_line_runs"] = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
keyed AS (
    SELECT doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
firsts AS (
    SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
judged AS (
    SELECT k.doc_id, k.line, k.pos, coalesce(k.doc_id > f.first_id, false) AS dropped FROM keyed k LEFT JOIN firsts f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return covertree.mine_negatives(table(spark, folder, "embeddings"))


ORACLES["op12_hard_negatives"] = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


@query
def op13_prefix_tour(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.prefix_trie(table(spark, folder, "conversations"))


ORACLES["op13_prefix_tour"] = """
WITH turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '') || chr(10) || coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
lengths AS (SELECT c, count(*) AS n FROM turns GROUP BY c),
convs AS (
    SELECT l.c, l.c - l.c % 5 AS base, coalesce(b.n, 0) AS n_base, xor(list_reduce(
               list_prepend(4294967295, list_transform(string_split(CAST(l.c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
               lambda r, b: list_reduce(list_prepend(xor(r, b), range(8)),
                   lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 9 AS h
    FROM lengths l LEFT JOIN lengths b ON b.c = l.c - l.c % 5),
rebuilt AS (
    SELECT v.c, t.pos AS d, t.role, t.text FROM convs v JOIN turns t ON t.c = v.base WHERE t.pos <= v.h
    UNION ALL
    SELECT v.c, t.pos - v.h + least(v.h, v.n_base), t.role, t.text FROM convs v JOIN turns t ON t.c = v.c WHERE t.pos > v.h),
paths AS (
    SELECT c, d, strlen(text) AS bytes, list({'r': role, 't': text}) OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS k FROM rebuilt
    UNION ALL
    SELECT c, 0, 0, CAST([] AS STRUCT(r VARCHAR, t VARCHAR)[]) FROM convs),
ends AS (
    SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS digest
    FROM (SELECT c, k FROM paths QUALIFY row_number() OVER (PARTITION BY c ORDER BY d DESC) = 1) GROUP BY k),
nodes AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saved FROM paths GROUP BY k, d),
parents AS (SELECT n.k, p.k AS pk, p.conv_id AS parent FROM nodes n JOIN nodes p ON n.d = p.d + 1 AND n.k[1:n.d - 1] = p.k),
children AS (SELECT pk AS k, count(*) AS n FROM parents GROUP BY pk),
subtrees AS (
    SELECT k[1:j] AS k, sum(saved) AS saved, sum(leaf) AS leaves
    FROM (SELECT n.k, n.saved, CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(n.d + 1)) AS j FROM nodes n LEFT JOIN children c ON c.k = n.k)
    GROUP BY 1)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.parent AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN parents p ON p.k = n.k LEFT JOIN children c ON c.k = n.k JOIN subtrees s ON s.k = n.k LEFT JOIN ends e ON e.k = n.k
"""
