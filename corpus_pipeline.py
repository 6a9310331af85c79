"""Documents to training tokens: the corpus operators chained into stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``. Each
stage works on all rows that its predecessor kept:

1. quality rules: documents that the rules or their host's verdict reject go;
2. SimHash near-duplicates (3-word shingles, 2 bits): of each group one
   document stays, that with the smallest id;
3. benchmark decontamination: documents that hold a benchmark item go;
4. secret scan: secrets in the text are replaced, all documents stay;
5. BPE: token ids of each text, with their count and the digests of ids and
   of the decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import bpe, decontaminate, quality_rules, secret_scan, simhash
from kerbside.llm.common import read_table, settle
from kerbside.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, text_col="text", host_col="source")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, shingle_words=3, max_distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), short_items=True)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs, text_col="text", length_col="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_decode(docs, tokenizer_path())
    return encoded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_duplicates), ("decontamination", decontamination),
          ("secret_scan", secrets), ("bpe", tokens)]

#: SQL cannot express the stages; the tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
