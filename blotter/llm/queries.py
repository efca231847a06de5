"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ball_codes import ball_codes, with_label_errors
from .common import shared_folder
from .decontaminate import contaminated
from .embeddings import embedding_groups
from .manifest import folded, leaf_digest, merkle_manifest, siblings
from .oracle_sql import ball_codes_sql, merkle_sql
from .packing import pack_documents
from .quality_rules import score_quality
from .secrets import scan_secrets
from .sentence_pieces import sentence_pieces
from .sharding import minimax_shards
from .simhash import simhash_groups
from .token_files import read_token_files, write_token_files
from .toxicity import score_toxicity
from .warc import archive_round_trip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["layers"] == "")

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):  # they come in order of start, then kind
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                         s["end"].cast("string"))))

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        F.col("unread").cast("long").alias("n_unread"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("similarity", F.round("similarity", 6)).drop("distance")


def op3_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op4_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                  train=_train()), 0.5)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), folder), folder)


def op7_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = archive_round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train=_train()), 0.3)


def op9_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimax_shards(table(spark, sf_dir, "documents"), 8)


def op10_pstable_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"))


def op11_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = ball_codes(table(spark, sf_dir, "embeddings"))
    numbers = ",".join(str(c) for book in books for entry in book for c in entry)
    return with_label_errors(codes).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    other = F.when(tampered, leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), lowered))
    proofs = merkle_manifest(docs, carry={"tampered": other})
    return (proofs.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
            .select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentence_pieces(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                         F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                         F.sha2("decoded", 256).alias("decoded_sha256"))


def _fold():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))


def _train():
    return _fold() != 0


def _scored(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select("doc_id", F.coalesce(_fold() == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secret_scan, op2_benchmark_decontamination, op3_hierarchical_packing, op4_simhash_bk_trees,
        op5_compression_toxicity, op6_token_files, op7_warc_normaliser, op8_rule_ensemble, op9_minimax_sharding,
        op10_pstable_embeddings, op11_ball_codes, op12_merkle_manifest,
        op13_sentence_pieces)
}

ORACLE_SQL: dict[str, str] = {
    # all windows of an item's length in every document that shares a shingle with it
    "op2_benchmark_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
        b AS (SELECT item_id, w, least(len(w), 5) AS k FROM
              (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark) WHERE len(w) > 0),
        i AS (SELECT item_id, k, len(w) - k + 1 AS m, [array_to_string(w[j:j + k - 1], ' ') for j in range(1, len(w) - k + 2)] AS s FROM b),
        t AS (SELECT doc_id, k, [array_to_string(w[j:j + k - 1], ' ') for j in range(1, len(w) - k + 2)] AS s
              FROM d, (SELECT DISTINCT k FROM b) WHERE len(w) >= k),
        th AS (SELECT DISTINCT doc_id, k, unnest(s) AS h FROM t),
        ih AS (SELECT item_id, k, h, count(*) AS n FROM (SELECT item_id, k, unnest(s) AS h FROM i) GROUP BY ALL),
        near AS (SELECT DISTINCT doc_id, item_id, k FROM th JOIN ih USING (k, h)),
        win AS (SELECT doc_id, item_id, k, m, r.start, t.s[r.start + 1:r.start + m] AS s
                FROM near JOIN t USING (doc_id, k) JOIN i USING (item_id, k),
                     LATERAL (SELECT unnest(range(0, greatest(0, len(t.s) - m) + 1)) AS start) r),
        wh AS (SELECT doc_id, item_id, k, m, start, h, count(*) AS n, any_value(size) AS size
               FROM (SELECT doc_id, item_id, k, m, start, len(s) AS size, unnest(s) AS h FROM win) GROUP BY doc_id, item_id, k, m, start, h),
        sim AS (SELECT doc_id, item_id, k, m, start, sum(least(wh.n, ih.n)) / (any_value(size) + m - sum(least(wh.n, ih.n))) AS similarity
                FROM wh JOIN ih USING (item_id, k, h) GROUP BY doc_id, item_id, k, m, start),
        best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS place
                 FROM sim WHERE similarity >= 0.8)
        SELECT doc_id, item_id, round(similarity, 6) AS similarity, start::INTEGER AS start_word, (m + k - 1)::INTEGER AS window_words
        FROM best WHERE place = 1""",
    "op7_warc_normaliser": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        g AS (SELECT html, max(page_id) AS newest FROM p
              WHERE octet_length(encode(html)) >= 1000 GROUP BY html HAVING count(*) > 1)
        SELECT p.page_id, octet_length(encode(p.html))::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
               CASE WHEN g.newest IS NULL OR g.newest = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN g.newest <> p.page_id THEN g.newest END AS refers_to
        FROM p LEFT JOIN g ON p.html = g.html""",
    "op10_pstable_embeddings": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        ok AS (SELECT * FROM v WHERE CASE WHEN e IS NULL OR len(e) = 0 OR list_count(e) < len(e) THEN false
               ELSE isfinite(list_dot_product(e, e)) AND list_dot_product(e, e) > 0 END),
        links AS (SELECT a.vec_id AS src, b.vec_id AS dst FROM ok a JOIN ok b ON a.vec_id <> b.vec_id
                  AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
        reach(src, dst) AS (SELECT src, dst FROM links UNION
                            SELECT r.src, l.dst FROM reach r JOIN links l ON r.dst = l.src),
        least AS (SELECT src, min(dst) AS dst FROM reach GROUP BY src),
        n AS (SELECT src, count(*) AS n FROM links GROUP BY src)
        SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(v.vec_id, coalesce(least.dst, v.vec_id)) AS component_id,
               v.vec_id = least(v.vec_id, coalesce(least.dst, v.vec_id)) AS kept
        FROM v LEFT JOIN n ON n.src = v.vec_id LEFT JOIN least ON least.src = v.vec_id""",
    "op11_ball_codes": ball_codes_sql(),
    "op12_merkle_manifest": merkle_sql(),
}
