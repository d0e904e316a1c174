"""The stages that turn `documents` into a training corpus.

Each stage takes (spark, docs, folder of the tables) and works on all rows that the one
before kept. All but the last return the columns of `documents`; the last returns the
token ids of each document that is left.
"""

import public_tokenizers
from pyspark.sql import functions as F

from starloom.llm import bpe, decontamination, line_dedup, ngram_join, quality_ranker
from starloom.llm.shipping import ship
from starloom.session import staging, staging_path


def keep_quality(spark, docs, sf_dir):
    """Drops documents that the ranker rejects; it learns from the labels that aren't held out.

    Without labels of both kinds nothing is rejected.
    """
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    ranker = quality_ranker.fit(docs, labels)
    kept = quality_ranker.scored(docs, ranker).filter("predicted = 1")
    return kept.select(*docs.columns)


def cut_repeated_lines(spark, docs, sf_dir):
    """Deletes passages that an earlier document has, and documents that were nothing else."""
    ship(spark)
    shorter = line_dedup.deduplicated(docs)
    left = shorter.filter((F.col("n_deleted") == 0) | F.col("text").rlike(f"[^{line_dedup.WHITE[1:-1]}]"))
    counted = F.when(F.col("n_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", counted).select(*docs.columns)


def one_of_near_copies(spark, docs, sf_dir):
    """Keeps the first document of each group of near duplicates."""
    ship(spark)
    return ngram_join.one_of_each(docs).select(*docs.columns)


def without_benchmarks(spark, docs, sf_dir):
    """Drops documents that hold a benchmark item."""
    ship(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def as_tokens(spark, docs, sf_dir):
    """Token ids of each document, and digests of them and of the text that they decode to."""
    ship(spark)
    done = bpe.encoded(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("word_bpe_49k.json"), decode=True)
    return done.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", cut_repeated_lines),
    ("n-gram Jaccard join", one_of_near_copies),
    ("benchmark decontamination", without_benchmarks),
    ("BPE encoding and decoding", as_tokens),
]

ORACLE_SQL = None  # no stage but the last can be told in SQL; tests hold each against plain Python


def run(spark, sf_dir):
    """The stages one after the other; each result is written to the shared folder.

    What a stage stages for itself goes when it is done; the stages' own results stay
    until the session ends, so that a lost executor costs one stage at most.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = staging_path(spark, name.replace(" ", "-"))
        with staging(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
