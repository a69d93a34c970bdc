"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it and reads it back as the documents of the next. All stages but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracemill.llm import mixing, packing, quality, secrets
from tracemill.llm.jaccard_join import jaccard_components
from tracemill.storage import Workspace

ORACLE_SQL = None  # SQL has no tokenizer and none of the seeded draws


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Rows without an id stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    judged = quality.score(docs, labels, host=F.col("source"), path=F.col("lang"))
    # Written, so that the optimizer knows the size of what goes before it moves texts.
    gone = Workspace(spark).save(judged.filter("not keep").select("doc_id").distinct(), "rejected")
    return docs.join(gone, "doc_id", "left_anti")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays, and
    of repeated rows of one id the first text. Rows without an id and texts
    without words stay."""
    linked = jaccard_components(docs)
    gone = Workspace(spark).save(linked.filter("component_id <> doc_id").select("doc_id").distinct(), "linked")
    stay = docs.join(gone, "doc_id", "left_anti")
    twice = Workspace(spark).save(
        docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if not twice.limit(1).count():
        return stay
    again = stay.join(twice, "doc_id", "left_semi")
    first = again.groupBy("doc_id").agg(F.min(F.struct(*(c for c in docs.columns if c != "doc_id"))).alias("d"))
    return stay.join(twice, "doc_id", "left_anti").unionByName(first.select("doc_id", "d.*"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is masked in the text; nothing else changes."""
    found, _ = secrets.scan(docs)
    hits = found.filter(F.size("spans") > 0).select(
        F.col("doc_id").alias("found_id"), F.col("blob").alias("found_blob"), "spans").dropDuplicates(["found_id", "found_blob"])
    blob = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    joined = docs.join(hits, docs["doc_id"].eqNullSafe(hits["found_id"]) & (blob == hits["found_blob"]), "left")
    masked = F.when(F.col("spans").isNull(), docs["text"]).otherwise(secrets.redacted(docs["text"], F.col("spans")))
    out = joined.withColumn("masked", masked)
    count = F.when(F.col("spans").isNull(), docs["n_chars"]).otherwise(F.char_length("masked").cast("long"))
    return out.select(*(
        {"text": F.col("masked").alias("text"), "n_chars": count.alias("n_chars")}.get(c, docs[c]) for c in docs.columns))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, which may be not at all."""
    mixed = mixing.mix(docs).filter("copies > 0").select(
        F.col("doc_id").alias("m_id"), F.col("source").alias("m_source"), F.col("size").alias("m_size"), "copies").distinct()
    same = (
        docs["doc_id"].eqNullSafe(mixed["m_id"]) & docs["source"].eqNullSafe(mixed["m_source"])
        & (mixing.words(docs["text"]) == mixed["m_size"]))
    taken = docs.join(mixed, same).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return taken.select(*(docs[c] for c in docs.columns))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = ws.save(stage(spark, docs, sf_dir), name)
        if before:
            ws.drop(before)
        before = name
    return docs
