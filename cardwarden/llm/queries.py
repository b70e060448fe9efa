"""One query per corpus operator, each over its whole table with the parameters meant for use."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm import bpe, decontaminate, exact_dedup, html_text, manifest, mixing, ngram_join, ngram_lm, packing
from cardwarden.llm import passages, token_counts, toxicity, whitening
from cardwarden.llm.common import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(toxicity.labelled_sample(docs, table(spark, sf_dir, "labels")))
    scores = toxicity.toxicity_scores(docs, model)
    return scores.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.bpe_round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", F.size("items").alias("n_items"), "items", "n_equal")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(table(spark, sf_dir, "pages"))


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents"))


def op9_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.lm_scores(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id and position matrices, written once; the result has their digests."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    packed = stored(packing.packed_texts(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), "packed", **packing.WRITING)
    digests = {f"{c}_sha256": F.sha2(c, 256) for c in ("ids", "positions")}
    return packed.withColumns(digests).drop("ids", "positions")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, text = table(spark, sf_dir, "documents"), F.col("text")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    claimed = F.when(tampered, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    return manifest.Manifest(manifest.document_leaves(docs, claimed)).proofs()


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


_ALL = (
    op1_toxicity, op2_ngram_join, op3_byte_bpe, op4_token_counts, op5_exact_dedup, op6_decontaminate,
    op7_html_text, op8_passages, op9_ngram_lm, op10_packing, op11_manifest, op12_whitening, op13_mixing,
)
QUERIES = {f.__name__: f for f in _ALL}

ORACLE = {
    "op5_exact_dedup": """
        WITH texts AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM texts WINDOW same AS (PARTITION BY t)
    """,
    "op11_manifest": r"""
        WITH RECURSIVE claims AS (
            SELECT *, CASE WHEN list_reduce(
                list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
                    lambda v, _: xor(v >> 1, CAST(3988292384 AS BIGINT) * (v & 1)))) % 2 = 1
                THEN replace(text, chr(10), '') ELSE text END AS claimed -- the CRC's last bit, before it is inverted
            FROM documents
        ), fields AS (
            SELECT row_number() OVER () AS id, doc_id, source,
                   coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
                   coalesce(strlen(text) || ':' || text, '-') AS body, coalesce(strlen(claimed) || ':' || claimed, '-') AS other
            FROM claims
        ), leaves AS (
            SELECT id, doc_id, source, sha256(head || body) AS leaf, sha256(head || other) AS claim FROM fields
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
        ), levels AS (
            SELECT source, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY source
            UNION ALL
            SELECT source, level + 1, list_transform(range((len(nodes) + 2) // 3), lambda k: sha256(array_to_string(nodes[3 * k + 1:3 * k + 3], '')))
            FROM levels WHERE len(nodes) > 1
        ), subroots AS (
            SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM levels WHERE len(nodes) = 1
        ), tops AS (
            SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
            UNION ALL
            SELECT level + 1, list_transform(range((len(nodes) + 2) // 3), lambda k: sha256(array_to_string(nodes[3 * k + 1:3 * k + 3], '')))
            FROM tops WHERE len(nodes) > 1
        ), ways AS (
            SELECT id, level, nodes, place // CAST(3 ** level AS BIGINT) AS spot
            FROM placed JOIN levels ON placed.source IS NOT DISTINCT FROM levels.source WHERE len(nodes) > 1
            UNION ALL
            SELECT id, 1000 + level, nodes, subroots.place // CAST(3 ** level AS BIGINT)
            FROM placed JOIN subroots ON placed.source IS NOT DISTINCT FROM subroots.source, tops WHERE len(nodes) > 1
        ), steps AS (
            SELECT id, row_number() OVER (PARTITION BY id ORDER BY level) AS step,
                   array_to_string(nodes[3 * (spot // 3) + 1:spot], '') AS left_, array_to_string(nodes[spot + 2:3 * (spot // 3) + 3], '') AS right_
            FROM ways
        ), folds AS (
            SELECT id, CAST(0 AS BIGINT) AS step, claim AS digest FROM leaves
            UNION ALL
            SELECT steps.id, steps.step, sha256(left_ || digest || right_) FROM folds JOIN steps ON steps.id = folds.id AND steps.step = folds.step + 1
        ), ends AS (
            SELECT id, arg_max(digest, step) AS folded_root FROM folds GROUP BY id
        ), proofs AS (
            SELECT id, sha256(string_agg(left_ || right_, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY id
        )
        SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
        FROM placed JOIN subroots ON placed.source IS NOT DISTINCT FROM subroots.source
        JOIN (SELECT nodes[1] AS root FROM tops WHERE len(nodes) = 1) ON true
        JOIN ends ON ends.id = placed.id LEFT JOIN proofs ON proofs.id = placed.id
    """,
    "op13_mixing": r"""
        WITH sizes AS (
            SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
            FROM documents
        ), sums AS (
            SELECT source, sum(size) AS source_size,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
            FROM sizes GROUP BY source
        ), levels AS ( -- after k sources, those with the smallest caps for their weight, are clamped
            SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER earlier, 0) AS rest,
                   sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS shared
            FROM sums
            WINDOW earlier AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), level AS (
            SELECT rest, shared FROM levels WHERE 3 * source_size * shared >= weight * rest ORDER BY shared DESC LIMIT 1
        ), targets AS (
            SELECT source, CAST(source_size AS BIGINT) AS source_size,
                   least(CAST(3 * source_size AS DOUBLE), CAST(weight * rest AS DOUBLE) / CAST(shared AS DOUBLE)) AS target
            FROM sums, level
        ), plan AS (
            SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget FROM targets
        ), ordered AS (
            SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS whole,
                   CASE WHEN source_size > 0 THEN budget % source_size ELSE 0 END AS more,
                   coalesce(sum(size) OVER (PARTITION BY sizes.source ORDER BY
                       CAST('0x' || substr(md5('13:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || size), 1, 15) AS BIGINT)
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM sizes JOIN plan ON sizes.source IS NOT DISTINCT FROM plan.source
        )
        SELECT doc_id, size, source_size, target,
               CAST(whole * size + greatest(0, least(size, more - before)) AS BIGINT) AS taken
        FROM ordered
    """,
}
