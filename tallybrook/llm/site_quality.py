"""Quality by documents' own evidence and the posteriors of their host and path.

A logistic model over shape features of a text (shares of kinds of characters, lengths of words and lines,
repetition) gives a document's own odds. It is fitted on at most ``SAMPLE`` labelled documents, chosen by a
hash of the id. A site is a host (the source without a URL's scheme, up to its first slash) and a path (the whole source). Grouped
sums of the own probabilities and of labels give each host a rate that is shrunk toward the global one, and
each path a rate shrunk toward its host's; the strengths come from the spread of the rates between hosts and
paths (method of moments), so sparse sites say little. A document's odds are its own, times its path's
over the global ones raised to ``SITE_SHARE``.

Defined results: a null text is empty and has an empty text's odds; a null source is a site of its own; rows that
repeat are scored again; labels that repeat or are null count by their mean, or not at all; without both kinds of label
every document gets 0.5 and is kept; an empty table gives no rows. Other columns pass through ``score_documents``.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallybrook.llm.common import ship

SAMPLE = 20_000
SITE_SHARE = 0.5
REJECT_BELOW = 0.5
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://"
_KINDS = np.full(256, 5)
_KINDS[[*range(97, 123)]] = 0
_KINDS[[*range(65, 91)]] = 1
_KINDS[[*range(48, 58)]] = 2
_KINDS[[0x20, *range(9, 14)]] = 3
_KINDS[128:] = 4
_MARKS = b"!%*&$#|.,"


def features(body: bytes) -> np.ndarray:
    n = len(body)
    counts = np.bincount(np.frombuffer(body, dtype=np.uint8), minlength=256)
    kinds = np.bincount(_KINDS, weights=counts, minlength=6) / max(n, 1)
    marks = counts[list(_MARKS)] / max(n, 1)
    words = body.split()
    lines = body.split(b"\n")
    k = max(len(words), 1)
    lengths = np.fromiter(map(len, words), dtype=float, count=len(words))
    return np.array([
        1.0, *kinds, *np.sqrt(marks), np.log1p(n) / 10, np.log1p(lengths.mean() if len(words) else 0),
        np.log1p(lengths.std() if len(words) else 0), len(set(words)) / k, len(set(lines)) / len(lines),
        np.log1p(len(lines) / k * 10), float(n == 0),
    ])


N_FEATURES = len(features(b""))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [features(b.as_py()).tobytes() for b in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], names=["label", "x"])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton's method with a ridge; classes weigh as they are."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    mean[0], spread[0] = 0, 1
    z, w = (x - mean) / spread, np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = (z * (p * (1 - p))[:, None]).T @ z + penalty
        w = w + np.clip(np.linalg.solve(hess, z.T @ (y - p) - penalty @ w), -5, 5)
    return w, mean, spread


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple | None:
    ship(docs.sparkSession)
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("label"))
    n = known.count()
    # The bound on what is fitted on; ids are hashed, so that the choice does not follow their order.
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(n, 1))))
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body")).join(chosen, "doc_id")
    table = rows.select("label", "body").mapInArrow(_features, "label double, x binary").toArrow()
    y = table.column("label").to_numpy()
    if not len(y) or y.min() >= 0.5 or y.max() < 0.5:
        return None
    x = np.frombuffer(b"".join(table.column("x").to_pylist())).reshape(len(y), -1)
    order = np.lexsort((*x.T, y))
    return fit(x[order], (y[order] >= 0.5).astype(float))


def with_evidence(docs: DataFrame, model: tuple | None) -> DataFrame:
    """``docs`` with the log odds of each text as ``_evidence``."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            if fitted:
                w, mean, spread = fitted
                for i, text in enumerate(batch.column(at)):
                    body = (text.as_py() or "").encode("utf-8", "surrogatepass")
                    out[i] = np.clip((features(body) - mean) / spread @ w, -12, 12)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "_evidence"])

    return docs.mapInArrow(score, docs.withColumn("_evidence", F.lit(0.0)).schema)


def _strength(rates: DataFrame, rate: str, n: str, toward) -> float:
    """How many documents the prior counts for: rate * (1 - rate) over the spread between groups."""
    row = rates.select(
        F.pow(F.col(rate) - toward, 2).alias("d2"), (toward * (1 - toward)).alias("v"), F.col(n).alias("n"),
    ).agg(
        F.sum(F.col("n") * F.col("d2")).alias("between"), F.sum("v").alias("within"), F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("v")).alias("nv"),
    ).first()
    if not row["n"]:
        return 10.0
    spread = max((row["between"] - row["within"]) / row["n"], 1e-6)
    return float(np.clip(row["nv"] / row["n"] / spread, 2.0, 1e4))


def site_posteriors(scored: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """``_path`` (null-safe) with its shrunk rate, and the global rate.

    Documents count by their label where they have one, else by their own probability.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("_label"))
    own = 1 / (1 + F.exp(-F.col("_evidence")))
    slim = scored.select("doc_id", F.col("source").cast("string").alias("_path"), own.alias("_own"))
    soft = slim.join(known, "doc_id", "left").withColumn("_p", F.coalesce("_label", "_own"))
    paths = soft.groupBy("_path").agg(F.count("*").alias("n"), F.sum(F.round("_p", 9).cast("decimal(28,9)")).cast("double").alias("good"))
    paths = paths.withColumn("_host", F.substring_index(F.regexp_replace("_path", SCHEME, ""), "/", 1))
    total = paths.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    base = float(np.clip((total["good"] or 0) / max(total["n"] or 0, 1), 0.01, 0.99)) if total["n"] else 0.5
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    host_k = _strength(hosts.withColumn("r", F.col("host_good") / F.col("host_n")), "r", "host_n", F.lit(base))
    hosts = hosts.withColumn("host_rate", (F.col("host_good") + host_k * base) / (F.col("host_n") + host_k))
    both = paths.alias("p").join(hosts.alias("h"), F.col("p._host").eqNullSafe(F.col("h._host"))).select("p.*", "host_rate")
    path_k = _strength(both.withColumn("r", F.col("good") / F.col("n")), "r", "n", F.col("host_rate"))
    rate = (F.col("good") + path_k * F.col("host_rate")) / (F.col("n") + path_k)
    return both.select(F.col("_path").alias("_site"), rate.alias("_rate")), base


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``_quality``, the posterior probability of being good."""
    model = learn(docs, labels, sample)
    scored = with_evidence(docs, model)
    if model is None:
        return scored.withColumn("_quality", F.lit(0.5)).withColumn("_site_rate", F.lit(0.5)).withColumn("_keep", F.lit(True))
    sites, base = site_posteriors(scored, labels)
    rate = F.greatest(F.lit(0.001), F.least(F.lit(0.999), F.col("_rate")))
    site = F.log(rate / (1 - rate)) - float(np.log(base / (1 - base)))
    joined = scored.join(sites, F.col("source").cast("string").eqNullSafe(F.col("_site")), "left")
    quality = 1 / (1 + F.exp(-(F.col("_evidence") + SITE_SHARE * F.coalesce(site, F.lit(0.0)))))
    return joined.withColumn("_quality", quality).withColumn("_site_rate", F.col("_rate")).withColumn(
        "_keep", F.col("_quality") >= REJECT_BELOW).drop("_site", "_rate")


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, evidence, site_rate, quality, keep."""
    slim = docs.select("doc_id", "text", "source")
    return score_documents(slim, labels, sample).select(
        "doc_id", F.col("_evidence").alias("evidence"), F.col("_site_rate").alias("site_rate"),
        F.col("_quality").alias("quality"), F.col("_keep").alias("keep"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that are not rejected, with their own columns, whatever their names."""
    own = {c: c if c in ("doc_id", "text", "source") else f"_in_{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*(F.col(f"`{c}`").alias(name) for c, name in own.items()))
    return score_documents(inner, labels, sample).where("_keep").select(*(F.col(name).alias(c) for c, name in own.items()))
