"""Small helpers shared by the operators of this package."""

import tempfile
import zipfile
from collections.abc import Iterator
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallybrook.session import scratch

# The white space that separates words, as a pattern for Java, Python and DuckDB alike.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
BATCH_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _ship(application: str) -> None:
    package = Path(__file__).resolve().parents[1]
    name = Path(tempfile.mkdtemp(prefix="package-")) / "tallybrook.zip"
    with zipfile.ZipFile(name, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    SparkSession.getActiveSession().sparkContext.addPyFile(str(name))


def ship(spark: SparkSession) -> None:
    """Spark hands this package to the Python workers, wherever the driver found it; once a session."""
    _ship(spark.sparkContext.applicationId)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Later steps read the files, so a lost executor costs a read and not the work above. An empty
    table comes back empty, with its columns.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the UTF-8 bytes of the text (null: no bytes); other columns stay behind."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"),
    )


def portions(texts: list, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` that hold about ``most`` bytes each, at least one text."""
    began = held = 0
    for i, text in enumerate(texts):
        if i > began and held + len(text) > most:
            yield began, i
            began, held = i, 0
        held += len(text)
    if began < len(texts):
        yield began, len(texts)
