"""Near-duplicate vectors by spherical-cap filters from structured random product codes.

A vector is turned by a fixed random rotation and cut into two blocks. A filter is one codeword of
each block's random code, so ``codewords ** 2`` filters are stated by ``2 * codewords`` vectors. A
vector's list is every filter whose direction it exceeds ``cap / sqrt(dimension)`` against; a vector
that exceeds fewer than ``least`` of them lists its ``least`` best ones. Vectors of a label that share
a filter are compared in double precision. A pair is compared for its first shared filter only, so
no pair is counted twice, and a bucket gives counts and a spanning forest, never its pairs.

Equal vectors of a label are one class throughout. A bucket of more than ``block`` classes is cut in
blocks, and each pair of blocks is a task's group of its own: a bucket with a third of all
rows is whole and never in one task.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and rows
without a label, link with nothing; vectors of different lengths are never compared; an empty table
gives no rows; other columns are ignored. A repeated row counts as another vector with the same id; a
row without an id is in no component of its own and is not kept.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallybrook.llm.common import ship, stored
from tallybrook.llm.components import components

CODEWORDS = 128
CAP = 3.3
LEAST = 12
BLOCK = 512


@cache
def _code(dimension: int, codewords: int, seed: int = 17) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    draw = np.random.default_rng(seed + dimension)
    turn = np.linalg.qr(draw.standard_normal((dimension, dimension)))[0]
    half = max(1, dimension // 2)
    code = [draw.standard_normal((codewords, n)) for n in (half, max(1, dimension - half))]
    return turn, *(c / np.linalg.norm(c, axis=1, keepdims=True) for c in code)


def filters_of(x: np.ndarray, codewords: int = CODEWORDS, cap: float = CAP, least: int = LEAST) -> np.ndarray:
    """The sorted filter numbers of a unit vector."""
    turn, left, right = _code(len(x), codewords)
    y = turn @ x
    half = max(1, len(x) // 2)
    low = y[half:] if len(x) > 1 else y
    score = ((left @ y[:half])[:, None] + (right @ low)[None, :]).ravel()
    found = np.flatnonzero(score > cap * np.sqrt(2 / len(x)))
    if len(found) < least:
        found = np.sort(np.argpartition(-score, min(least, len(score) - 1))[:least])
    return found.astype(np.int32)


def _unit(values: np.ndarray) -> np.ndarray:
    x = np.asarray(values, dtype=np.float64)
    x = x / np.abs(x).max()
    return x / np.sqrt(x @ x)


def _first_shared(a: list[np.ndarray], b: list[np.ndarray], filter_id: int) -> np.ndarray:
    """Whether ``filter_id``, which all share, is the first filter that a row of a and one of b share."""
    seen: dict[int, list[tuple[int, int]]] = {}
    for side, lists in enumerate((a, b)):
        for i, one in enumerate(lists):
            for f in one[: np.searchsorted(one, filter_id)].tolist():
                seen.setdefault(f, []).append((side, i))
    first = np.ones((len(a), len(b)), dtype=bool)
    for rows in seen.values():
        ia, ib = [i for s, i in rows if s == 0], [i for s, i in rows if s == 1]
        if ia and ib:
            first[np.ix_(ia, ib)] = False
    return first


def _forest(rows: np.ndarray, cols: np.ndarray) -> list[tuple[int, int]]:
    parent: dict[int, int] = {}

    def top(i: int) -> int:
        while parent.setdefault(i, i) != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for i, j in zip(rows.tolist(), cols.tolist(), strict=True):
        a, b = top(i), top(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append((i, j))
    return kept


def similar_vectors(
    vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", codewords: int = CODEWORDS, cap: float = CAP, least: int = LEAST,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    ship(vectors.sparkSession)
    v = F.col(vector_col).cast("array<double>")
    usable = (
        F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (F.size(v) > 0)
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        F.when(usable, F.transform(v, lambda x: x + F.lit(0.0))).alias("v"),
    )
    rows = rows.withColumn("key", F.when(F.col("v").isNotNull(), F.sha2(F.concat_ws(" ", "label", F.to_json("v")), 256)))
    classes = stored(
        rows.where("key is not null").groupBy("key").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("copies"),
            F.first("label").alias("label"), F.first("v").alias("v"),
        ), "classes",
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for rep, copies, label, values in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                x = _unit(values)
                listed = filters_of(x, codewords, cap, least)
                data, own = x.tobytes(), listed.tobytes()
                out.extend((rep, copies, f"{label}/{len(x)}", int(f), data, own) for f in listed)
            names = ["rep", "copies", "label", "filter", "x", "listed"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary()]
            for i in range(0, len(out), 20_000):
                columns = zip(*out[i : i + 20_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    listed = stored(classes.select("rep", "copies", "label", "v").mapInArrow(
        decode, "rep long, copies long, label string, filter int, x binary, listed binary"
    ), "filters")
    sizes = listed.groupBy("label", "filter").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    # A row goes to each pair of blocks that its own block is in.
    dealt = (
        listed.join(sizes, ["label", "filter"]).withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
        .drop("n", "blocks", "other")
    )

    def compare(group: pa.Table) -> pa.Table:
        reps, copies, own = (group.column(c).to_numpy() for c in ("rep", "copies", "own"))
        x = np.frombuffer(b"".join(group.column("x").to_pylist())).reshape(len(reps), -1)
        lists = [np.frombuffer(b, dtype=np.int32) for b in group.column("listed").to_pylist()]
        filter_id = group.column("filter")[0].as_py()
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        if not len(left) or not len(right):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        # The product rounds differently with the shape of the blocks, so pairs at the edge are done alone.
        product = x[left] @ x[right].T
        edge = np.argwhere(np.abs(product - cosine) < 1e-9)
        for i, j in edge:
            product[i, j] = float(np.sum(x[left[i]] * x[right[j]]))
        linked = product >= cosine
        if low == high:
            linked &= ~np.eye(len(left), dtype=bool)
        if linked.any():
            linked &= _first_shared([lists[i] for i in left], [lists[i] for i in right], filter_id)
        counts = np.zeros(len(reps), dtype=np.int64)
        counts[left] += linked @ copies[right]
        if low != high:
            counts[right] += linked.T @ copies[left]
        i, j = np.nonzero(linked)
        tree = _forest(left[i], right[j])
        some = np.flatnonzero(counts)
        a = np.r_[reps[some], reps[[i for i, _ in tree]]] if tree else reps[some]
        b = np.r_[reps[some], reps[[j for _, j in tree]]] if tree else reps[some]
        links = np.r_[counts[some], np.zeros(len(tree), dtype=np.int64)]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array(links, pa.int64())})

    found = stored(dealt.groupBy("label", "filter", "low", "high").applyInArrow(compare, "a long, b long, links long"), "found")
    counts = found.where("a = b").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "rep")
    groups = components(found.where("a <> b").select("a", "b")).withColumnRenamed("node", "rep")
    known = classes.select("key", "rep", "copies").join(counts, "rep", "left").join(groups, "rep", "left")
    joined = rows.select("vec_id", "key").join(known, "key", "left")
    component = F.coalesce("component", "rep", "vec_id")
    return joined.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
