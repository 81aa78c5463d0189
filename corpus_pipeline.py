"""A training corpus from ``documents``: select, clean, deduplicate, decontaminate, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``. A decision about a document is
joined back by doc_id and a hash of the text, so null ids and two texts under
one id stay apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapeloom.llm import decontaminate, line_dedup, mixing, near_dedup, quality
from shapeloom.llm.storage import documents, run_dir, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _by_row(docs: DataFrame, decisions: DataFrame, how: str) -> DataFrame:
    """``docs`` joined to the decision rows (doc_id, text_hash, ...) about them."""
    d = decisions.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    keyed = docs.select(*COLUMNS).withColumn("_text_hash", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    return keyed.join(d, same, how)


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; null and wordless texts are rejected.

    Rows equal in id and text are judged alike; the whole of a text counts; an
    empty table gives none.
    """
    model = quality.train(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    judged = quality.classify(docs, model).where("kept").select("doc_id", "text_hash").distinct()
    return _by_row(docs, judged, "left_semi").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stood before go, runs of one line included; a document of which no line is left goes as well.

    Rows equal in id and text are one document and come out alike. Null,
    empty and blank texts lose nothing and stay; an empty table gives none.
    """
    kept = line_dedup.dedup_lines(docs.select(*COLUMNS)).where("_removed = 0 or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays: the smallest doc_id (null last), then the least text hash.

    Groups are told apart by their node, not by their name, so unlike texts
    without doc_id or under one doc_id stay each. Rows equal in both give one.
    """
    groups = near_dedup.near_groups(docs).where("n_shingles > 0")
    rows = groups.groupBy("node", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("_n"))
    one = rows.groupBy("node").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "_n")).alias("one"))
    joined = _by_row(docs, one.select("one.doc_id", "one.text_hash", "one._n"), "inner").select(*COLUMNS, "_n", "_text_hash")
    single = joined.where("_n = 1")
    repeated = joined.where("_n > 1").dropDuplicates(["doc_id", "_text_hash"])
    # empty sets link with nothing: those rows stay
    empty = docs.where("text is null or not text rlike '[^\\\\x20\\\\x09-\\\\x0D]'").select(*COLUMNS)
    return single.unionByName(repeated).select(*COLUMNS).unionByName(empty)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go.

    Null and wordless texts hold none and stay; rows equal in id and text go
    or stay together; whole texts are searched; empty tables on either side
    take nothing.
    """
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return _by_row(docs, found.select("doc_id", "text_hash").distinct(), "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each remaining document the mix takes (see ``mixing.Mix``).

    A row per row: null and empty texts have size 0 and give nothing, repeated
    rows are documents of their own, a null source is a source; an empty table
    gives none.
    """
    return mixing.Mix(docs).per_document().select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("quality_classifier", select_quality),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", dedup_near),
    ("benchmark_decontamination", drop_contaminated),
    ("mix_sources", mix_sources),
]

#: The classifier's weights and the hash draws have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES in order to the documents of ``sf_dir``."""
    folder = run_dir(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), folder, f"{k}-{name}")
    return docs
