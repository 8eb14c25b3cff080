"""The corpus pipeline: quality, near duplicates, secrets, mixing, packing, each over what the one before kept."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallybrook.llm import mixing, packing, secrets, setsketch, site_quality
from tallybrook.llm.common import stored, table
from tallybrook.llm.registry import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return site_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def unused(docs: DataFrame, name: str) -> str:
    return name if name not in docs.columns else unused(docs, f"_{name}")


def with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, once. Rows that share an id but not a text are documents of their own, told
    apart by a negative number from both; rows without an id can't be told apart and stay."""
    said = F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.col("text").isNull())
    hashes = docs.where("doc_id is not null").select("doc_id", said.alias("said")).groupBy("doc_id")
    shared = stored(hashes.agg(F.min("said").alias("low"), F.max("said").alias("high")).where("low <> high").select("doc_id"), "shared")
    row = unused(docs, "row_key")
    own = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1)
    mark = shared.withColumn(f"{row}_shared", F.lit(True))
    keyed = docs.join(mark, "doc_id", "left").withColumn(
        row, F.when(F.col(f"{row}_shared"), -own).otherwise(F.col("doc_id").cast("long"))).drop(f"{row}_shared")
    found = setsketch.near_duplicates(keyed, id_col=row)
    dropped = found.where("not kept and doc_id is not null").select(F.col("doc_id").alias(row)).distinct()
    named = keyed.where(F.col(row).isNotNull()).join(dropped, row, "left_anti").dropDuplicates([row])
    return named.select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(docs.where("doc_id is null"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; the spans found are replaced in its text and n_chars follows."""
    return with_length(secrets.redact(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_length(mixing.repeat_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_duplicates),
    ("secret scans", hide_secrets),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack),
]
# Models, hashes and a tokenizer decide the rows; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs, "stage")
    return docs


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
