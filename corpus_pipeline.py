"""Five stages from raw documents to packed training sequences.

1. ``quality``: the rule ensemble scores every document; those under
   ``QUALITY_LEAST`` go.
2. ``near_duplicates``: SimHash groups with BK-trees; the document with the
   smallest id of each group stays.
3. ``decontaminate``: documents with a benchmark passage go.
4. ``secrets``: secrets, also those under layers of encoding, are masked in the
   texts; all documents stay and ``n_chars`` counts the masked text.
5. ``pack``: the texts become pieces of packed sequences.

Each stage works on all that its predecessor kept, written as Parquet in the
shared folder and read again. Decisions are tied to a document by a digest of
its id and text, so null and repeated ids are handled row by row; repeated rows
get the same decision, and stage 2 keeps one of them. A stage that drops
documents shuffles the texts once, by that digest.

Nulls and edges: a null text is judged as an empty one; an empty table passes
through every stage as an empty table; extra columns of ``documents`` are kept
as they are up to the last stage, whatever they are called (a stage gives its own
columns names that the table does not hold).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.common import stored
from blotter.llm.decontaminate import contaminated
from blotter.llm.packing import pack_documents
from blotter.llm.quality_rules import score_quality
from blotter.llm.secrets import redact_secrets
from blotter.llm.simhash import keep_one_each, simhash_groups

QUALITY_LEAST = 0.3


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``docs`` is called so."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _columns(docs: DataFrame) -> list[Column]:
    """All columns of ``docs``, also those with a dot in their name."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a digest of id and text, and the name of that column."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    text = F.coalesce(F.concat(F.lit(":"), F.col("text")), F.lit(""))  # a null text is not an empty one
    key = _unused(docs, "text_digest")
    return docs.withColumn(key, F.sha2(F.concat(doc_id, text), 256)), key


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed, key = _keyed(docs)
    train = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0
    scores = score_quality(keyed, _table(spark, sf_dir, "labels"), train=train, key_col=key)
    good = scores.filter(F.col("score") >= QUALITY_LEAST).select(F.col("key").alias(key))
    return keyed.join(good, key, "left_semi").select(_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed, key = _keyed(docs)
    winners = keep_one_each(simhash_groups(keyed, key_col=key)).select(F.col("key").alias(key))
    row = _unused(docs, "row_of_digest")
    one = Window.partitionBy(key).orderBy(key)  # more than one only where a row is repeated; shuffled by the key already
    left = keyed.join(winners, key, "left_semi").withColumn(row, F.row_number().over(one))
    return left.filter(F.col(row) == 1).select(_columns(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed, key = _keyed(docs)
    found = contaminated(keyed, _table(spark, sf_dir, "benchmark"), id_col=key)
    bad = stored(found.select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return keyed.join(bad, key, "left_anti").select(_columns(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = redact_secrets(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.coalesce(F.char_length("text"), F.col("n_chars")).cast(kind))
    return masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [("quality_rule_ensemble", quality), ("simhash_near_dedup", near_duplicates),
          ("benchmark_decontamination", decontaminate), ("secret_scans", secrets), ("hierarchical_packing", pack)]

#: Trained models, SimHash and tokenizers are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
