"""The corpus pipeline: stages that each take the documents that the stage before has kept.

Each function takes (spark, docs, sf_dir). All but the last return the columns of documents: toxic documents, near copies and texts
that benchmark items leak into go, secrets are replaced; the last encodes what is left.

In every stage null and empty texts are documents like others (they are never toxic by a lexicon word, near copies, leaks or secrets, and
have no tokens), very long texts count whole, rows that repeat each count, and an empty table gives an empty table. Further columns of
documents pass through all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe_tree, secrets_dfa, setsketch, tiling, toxicity
from quire.llm.shared import stored


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity model scores 0.5 or more (a tie goes); it learns from labels outside the held-out fold.

    Rows of one id are scored each by its own text; a null id is scored like any other.
    """
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    model = toxicity.train(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out))
    return toxicity.clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near copies (five-word shingles, similarity 0.8 or more).

    Rows of one id are one document: they stay or go together. Null ids and texts without words stay.
    """
    gone = setsketch.link(spark, docs, k=5, percent=80).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a benchmark item leaks into, row by row; items of fewer than five words and null items leak nowhere."""
    return tiling.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each secret in the texts, row by row; n_chars, where there is one, follows the new text and is null for a null text."""
    out = secrets_dfa.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each row left; a null or empty text has no ids."""
    import public_tokenizers

    coded = bpe_tree.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", hide_secrets),
    ("encoding", encode),
]

#: SQL can express neither the trees nor the tokenizer; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
