"""Corpus pipeline: documents in, packed token sequences out.

``STAGES`` names the stages in order. Each takes ``(spark, docs, sf_dir)``, works on all that
its predecessor kept, and is written as Parquet and read again before the next one begins. All
but the last return the columns of ``documents``; the last returns the pieces of the packed
sequences. ``ORACLE_SQL`` is ``None``: a trained model and samples are not expressible in SQL.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolquarry.llm import decontam, lines, neardup, packing
from toolquarry.llm import toxicity as toxic
from toolquarry.llm.queries import held_out, tokenizer_file
from toolquarry.llm.work import stored, work_folder

ORACLE_SQL = None
REJECT = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that score ``REJECT`` or more go; the model is fitted on labels of these documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    scored = toxic.score_toxicity(docs, toxic.fit_toxicity(docs, labels))
    return scored.where(F.col("toxicity") < REJECT).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks go from the texts; every document stays, ``n_chars`` follows."""
    kept = lines.dedup_lines(docs)
    if "n_chars" in docs.columns:
        changed = F.when(F.size("removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        kept = kept.withColumn("n_chars", changed.otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return neardup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of the benchmark go."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return packing.pack(docs, tokenizer_file(), 1024)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` on."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), folder, name)
    return docs
