"""Language of texts by multinomial naive Bayes over hashed character n-grams.

A text is lowered, every character that is no letter becomes a space, runs of spaces become one, and
all runs of one to three characters are hashed into ``BUCKETS``. Counts by language and bucket are
summed inside each task before Spark adds them up, over all rows that may be learned from. The matrix of
log-probabilities (languages times buckets) is broadcast; the batches are scored in numpy from the
buckets that occur.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text where
nothing could be learned; texts are taken whole, in slices, however long; a repeated row is learned
from and predicted again; languages that score equally come in order of their names; an empty table
gives no rows. A null language is never learned. ``score`` is the posterior of the chosen language.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallybrook.llm.common import ship

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
SLICE = 1 << 18
HELD_LANGUAGES = 64


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)], dtype=bool)


def gram_buckets(text: str) -> Iterator[np.ndarray]:
    """The buckets of a text's n-grams, a slice at a time; nothing where it has no letter.

    The last characters of a slice are carried into the next, so slices change no gram.
    """
    lowered, waiting = text.lower(), []
    carried, blank, lettered = np.array([], dtype=np.uint64), False, False
    for at in range(0, len(lowered), SLICE):
        raw = np.frombuffer(lowered[at : at + SLICE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        raw = np.where(_letters()[raw], raw, np.uint32(32))
        keep = raw != 32
        lettered = lettered or bool(keep.any())
        keep[1:] |= raw[:-1] != 32
        keep[0] |= not blank
        blank = raw[-1] == 32
        ends = [32] if at + SLICE >= len(lowered) else []
        raw = np.concatenate((carried, [] if at else [32], raw[keep], ends)).astype(np.uint64)
        found, total = [], raw * np.uint64(0x9E3779B97F4A7C15)
        for n in ORDERS:
            if n > 1:
                if len(total) < 2:
                    break
                total = (total[:-1] * np.uint64(0x100000001B3)) ^ (raw[n - 1 :] * np.uint64(0xC2B2AE3D27D4EB4F))
            # Grams that end in what was carried are counted already.
            fresh = total[max(0, len(carried) - n + 1) :]
            mixed = (fresh ^ (fresh >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            found.append((mixed >> np.uint64(64 - 15)).astype(np.int32))
        carried = raw[-(max(ORDERS) - 1) :]
        waiting.append(np.concatenate(found))
        if lettered:  # slices without a letter leave one blank each at most
            yield from waiting
            waiting = []


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, list[int]]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, (counts, n) in held.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(some) + 1), pa.string()), pa.array(np.r_[some, -1], pa.int32()), pa.array(np.r_[counts[some], n[0]], pa.int64())],
                names=["lang", "bucket", "n"],
            )
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            seen = False
            for buckets in gram_buckets(text.as_py()):
                if lang not in held and len(held) >= HELD_LANGUAGES:
                    yield from out()
                counts, n = held.setdefault(lang, (np.zeros(BUCKETS, dtype=np.int64), [0]))
                counts += np.bincount(buckets, minlength=BUCKETS)
                n[0] += not seen
                seen = True
    yield from out()


def learn(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log priors, and the log-probability matrix (languages, buckets)."""
    ship(rows.sparkSession)
    known = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counted = known.where("lang is not null and text is not null").mapInArrow(_count, "lang string, bucket int, n long")
    # As many rows as languages times buckets, however large the corpus is.
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names, index = np.unique(np.array(table.column("lang").to_pylist(), dtype=object), return_inverse=True)
    bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy().astype(float)
    docs, counts = np.zeros(len(names)), np.zeros((len(names), BUCKETS))
    docs[index[bucket < 0]] = n[bucket < 0]
    counts[index[bucket >= 0], bucket[bucket >= 0]] = n[bucket >= 0]
    counts += SMOOTHING
    prior = np.log(docs / docs.sum()) if len(names) else docs
    return list(names), prior, np.log(counts / counts.sum(axis=1, keepdims=True))


def predict(docs: DataFrame, model: tuple, text_col: str = "text", keep: tuple[Column, ...] = ()) -> DataFrame:
    """The columns of ``keep`` with lang_pred and score."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prior, matrix = shared.value
        # A bucket's log-probabilities lie together.
        by_bucket = np.ascontiguousarray(matrix.T)
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(batch.num_columns - 1):
                sums, text = prior.copy(), text.as_py()
                seen = False
                for buckets in gram_buckets(text or ""):
                    seen = True
                    if len(buckets) > BUCKETS:
                        sums += np.bincount(buckets, minlength=BUCKETS) @ by_bucket
                    else:
                        sums += by_bucket[buckets].sum(axis=0)
                if not seen or not names:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                best = int(sums.argmax())
                langs.append(names[best])
                scores.append(float(1 / np.exp(sums - sums[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score"],
            )

    given = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    schema = given.drop("_text").withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0)}).schema
    return given.mapInArrow(score, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; rows held out (crc32 of the id mod 3 is 1) teach nothing."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(True))
    model = learn(docs.where(~held))
    return predict(docs, model, keep=(F.col("doc_id"), held.alias("held_out")))
