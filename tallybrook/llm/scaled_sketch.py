"""Document fingerprints by threshold-scaled sketches of word shingles.

A fingerprint holds every hash of a five-word shingle that lies below a fixed fraction of the hash
range (``FRACTION``), the same for every text, so fingerprints intersect without bias between documents of very unequal
lengths, and the fingerprint of a union is the union of fingerprints. The likeness of two texts is the containment
of the smaller fingerprint in the larger one, and comes from the two fingerprints alone. For a true containment c and
n shingles in the smaller text its standard error is sqrt(c (1 - c) / (n FRACTION)): 0.16 for c = 1/2 and twenty shingles,
0.02 for a thousand. Where c is 0 or 1 and a hash is retained it is exact.

For the edited text every document needs the one that follows it by ``doc_id``. Rows are dealt by ranges
of ids, in one shuffle of the texts; the first row of each range is also sent to the range before it (that of
the first range to the last), and each range is then read in order, holding two texts at a time.

Defined results: a null text is empty; an empty or wordless text has the fingerprint '' and likeness
0 to others, 1 to another empty one; a text with words whose hashes all lie above the fraction (a half of texts with one
shingle, one in a thousand with ten) has the fingerprint '-' and likeness 0 to all; rows are in order of id (null first), then text, and a repeated row
is its own next document; a single row follows itself; an empty table gives no rows.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

from tallybrook.llm.common import ship
from tallybrook.llm.shingles import shingle_sets
from tallybrook.operators.keyed_join import estimated_bytes

FRACTION = 1 / 2
# Ranges of ids at least, and the bytes of input that one may hold at most where there are more.
RANGES = 256
RANGE_BYTES = 1 << 30
_LIMIT = np.uint64(int(FRACTION * 2**64))
NONE_BELOW = "-"


def retained(hashes: np.ndarray) -> np.ndarray:
    """Those of a sorted set below the fraction."""
    return hashes[: int(np.searchsorted(hashes, _LIMIT))]


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The fingerprint of the union of two sets, from theirs."""
    return np.union1d(a, b)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Of the smaller of two fingerprints in the larger; 0 where either holds nothing."""
    if not len(a) or not len(b):
        return 0.0
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def hashes_in(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("" if fingerprint == NONE_BELOW else fingerprint), dtype=">u8").astype(np.uint64)


def likeness(one: str, other: str) -> float:
    """Of two fingerprints as they are returned."""
    if not one and not other:
        return 1.0
    return containment(hashes_in(one), hashes_in(other))


def fingerprint(hashes: np.ndarray) -> str:
    """Of a sorted set of shingle hashes, as text."""
    if not len(hashes):
        return ""
    return retained(hashes).astype(">u8").tobytes().hex() or NONE_BELOW


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range and then in order; a row meets the next of its range. Guests only follow."""
    before = None
    for batch in batches:
        rows, held = [], 0
        for part, guest, doc, text in zip(*(batch.column(i) for i in range(4)), strict=True):
            now = (part.as_py(), guest.as_py(), doc.as_py(), text.as_py() or "")
            if before and not before[1]:
                rows.append((before[2], before[3], now[3]))
                held += len(before[3]) + len(now[3])
            before = now
            if held > 1 << 20:
                yield _finger(rows)
                rows, held = [], 0
        if rows:
            yield _finger(rows)


def _finger(rows: list[tuple]) -> pa.RecordBatch:
    changed = [edited(t, f) for _, t, f in rows]
    data = [[x.encode("utf-8", "surrogatepass") for x in texts] for texts in ([t for _, t, _ in rows], changed, [f for _, _, f in rows])]
    own, new, following = ([fingerprint(s) for s in shingle_sets(texts)] for texts in data)
    columns = [
        pa.array([d for d, _, _ in rows], pa.int64()), pa.array([len(t) for _, t, _ in rows], pa.int64()),
        pa.array([hashlib.sha256(x).hexdigest() for x in data[1]]), pa.array(own, pa.string()),
        pa.array(new, pa.string()),
        pa.array([likeness(a, b) for a, b in zip(own, new, strict=True)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(own, following, strict=True)], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def ranges_for(docs: DataFrame) -> int:
    """As many as keep a range near ``RANGE_BYTES`` of what the optimizer takes the input for."""
    return max(RANGES, -(-(estimated_bytes(docs) or 0) // RANGE_BYTES))


def fingerprints(docs: DataFrame, ranges: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    ranges = ranges_for(docs) if ranges is None else ranges
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    numbers = rows.select(F.col("doc_id").cast("double").alias("x")).where("x is not null")
    cuts = numbers.approxQuantile("x", [i / ranges for i in range(1, ranges)], 0.2 / ranges)
    splits = [-float("inf"), *sorted({*cuts} or {0.0}), float("inf")]
    deal = Bucketizer(splits=splits, inputCol="x", outputCol="range")
    placed = deal.transform(rows.withColumn("x", F.coalesce(F.col("doc_id").cast("double"), F.lit(-float("inf")))))
    placed = placed.select(F.col("range").cast("int").alias("range"), "doc_id", "text")
    # One id for each range at most: the number of ranges is a parameter.
    firsts = [
        r for r in placed.groupBy("range").agg(
            F.min("doc_id").alias("doc_id"), F.max(F.col("doc_id").isNull()).alias("nulls")).collect()
    ]
    firsts.sort(key=lambda r: r["range"])
    before = {r["range"]: firsts[i - 1]["range"] for i, r in enumerate(firsts)}
    ids = spark.createDataFrame(
        [(before[r["range"]], r["range"], None if r["nulls"] else r["doc_id"]) for r in firsts],
        "to int, range int, doc_id long")
    ids = F.broadcast(ids)
    guests = (
        placed.alias("p").join(ids.alias("g"), (F.col("p.range") == F.col("g.range")) & F.col("p.doc_id").eqNullSafe(F.col("g.doc_id")))
        .groupBy(F.col("g.to").alias("range"), F.col("p.doc_id").alias("doc_id")).agg(F.min("p.text").alias("text"))
    )
    all_rows = placed.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    dealt = all_rows.repartition(max(1, len(firsts)), "range").sortWithinPartitions(
        "range", "guest", F.col("doc_id").asc_nulls_first(), "text")
    return dealt.select("range", "guest", "doc_id", "text").mapInArrow(
        _pairs, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
