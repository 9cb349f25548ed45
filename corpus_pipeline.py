"""A training corpus from raw documents: languages, near duplicates, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before has kept; all but the last return the
columns of ``docs``, so more columns than those of ``documents`` pass through. ``run`` writes each stage's rows as
Parquet to the shared folder and reads them again for the next one.

- ``language_id`` learns from a bounded sample of the labelled rows and drops texts that are near no language's
  centroid: null texts, texts without a letter, and noise.
- ``near_duplicates`` keeps one row of each SimHash group: the smallest ``doc_id`` (null last), the first row of equals.
- ``decontamination`` drops texts of which one word in 20 or more lies in passages of ``benchmark``.
- ``encoding`` gives the ids of the 32k piece vocabulary with an end id, and whether they decode to the text.

An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearcurve.llm import decontam, langid, pieces, simhash
from wearcurve.llm.catalogue import table, tokenizer_path
from wearcurve.sources.tables import materialize


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have in any case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs)
    found = _unused(docs, "found")
    return docs.withColumn(found, langid.predict("text", model, spark)).where(~F.col(found)["rejected"]).drop(found)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = _unused(docs, "row")
    # written with row numbers, so that rows are the same wherever they are read
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    plain = numbered.select(F.col(row).alias("row_number"), "doc_id", "text")
    groups = simhash.near_duplicates(plain, keep="row_number")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_number"))["row_number"]
    kept = groups.groupBy("group").agg(first.alias(row)).select(row)
    return numbered.join(kept, row, "left_semi").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    key = _unused(docs, "contaminated_key")
    bad = found.where("contaminated").select(F.col("key").alias(key)).distinct()
    return docs.withColumn(key, decontam.text_key(F.col("text"))).join(bad, key, "left_anti").select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = pieces.load_model(tokenizer_path("piece"))
    found = docs.select("doc_id", "lang", "source", pieces.round_trip("text", model).alias("found"))
    return found.select(
        "doc_id",
        "lang",
        "source",
        "found.ids",
        F.size("found.ids").cast("long").alias("n_tokens"),
        F.col("found.same").alias("round_trip"),
    )


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: SQL has neither the classifier nor the fingerprints nor the encoder; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
