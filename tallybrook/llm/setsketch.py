"""Near-duplicate documents by SetSketch registers.

A register is the truncated logarithm, to base ``BASE``, of the least exponential value among a set's
shingles. Registers of a union are the greater ones of its parts, so sketches merge; and two sets
agree in a register about as often as their similarity says. Runs of ``ROWS`` registers are bands; sets
that agree in a band are candidates. The similarity of a candidate pair is estimated from all
registers and both set sizes by maximum likelihood; pairs estimated far below the bound go, the
rest is compared on full sets.

Documents with equal sets are one class. In a band every class is first compared with the band's least
class, which settles groups of copies without listing their pairs. Bands that still hold several
components are then compared in blocks, which hold a bounded number of classes and shingles: each class
outside the first component with every class of another component, on registers and, where these
make it likely, on full sets. Only links that join components leave the task. No band is capped.

At similarity 0.75 a pair shares no band with a probability of about 1e-5 and is estimated below
``DOUBT`` with about 1e-6; no other link is lost.

Defined results: a null or wordless text has no shingles and links with nothing; texts of any length
are taken whole; a repeated row is reported again; a row without an id links with nothing; an empty
table gives no rows; other columns are ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallybrook.llm.common import id_and_bytes, ship, stored
from tallybrook.llm.components import components
from tallybrook.llm.shingles import mix, odd_numbers, shingle_sets

BASE = 1.001
RATE = 20.0
TOP = (1 << 16) - 2
ROWS = 3
BANDS = 21
REGISTERS = ROWS * BANDS
DOUBT = 0.5
BLOCK = 2048
MARKS = 1 << 20
BLOCK_SHINGLES = 1 << 21
_STEP = 1 << 10
_AT_ONCE = 1 << 17
_GRID = np.linspace(0.0, 1.0, 129)


def registers_of(hashes: np.ndarray) -> np.ndarray:
    """The registers of a set, from the 64-bit hashes of its members."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    turns = odd_numbers(REGISTERS, 23)
    for at in range(0, len(hashes), _STEP):
        part = mix(hashes[at : at + _STEP] + np.uint64(1))
        np.minimum(least, np.multiply.outer(turns, part).min(axis=1), out=least)
    # The least of exponential values, from the least of uniform ones.
    value = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(np.maximum(value, 1e-300)) / np.log(BASE)), 0, TOP + 1).astype("<u2")


def likeliest(above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity at which so many registers of the first lie above and below those of the second."""
    u = n_a / (n_a + n_b)
    bound = np.minimum(u / (1 - u), (1 - u) / u)

    def chance(x: np.ndarray) -> np.ndarray:
        return np.maximum(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12)

    def score(at: np.ndarray) -> np.ndarray:
        j = _GRID[at] * bound
        up, down = chance(u - (1 - u) * j), chance(1 - u - u * j)
        equal = np.maximum(1 - up - down, 1e-12)
        return above * np.log(up) + below * np.log(down) + (REGISTERS - above - below) * np.log(equal)

    # The likelihood is concave in the similarity: its greatest grid point is where it stops rising.
    low, high = np.zeros(u.shape, dtype=int), np.full(u.shape, len(_GRID) - 1)
    while (low < high).any():
        middle = (low + high) // 2
        rises = score(np.minimum(middle + 1, len(_GRID) - 1)) > score(middle)
        low, high = np.where(rises & (low < high), middle + 1, low), np.where(rises, high, middle)
    return _GRID[low] * bound


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, sketches = [], [], []
        for one in shingle_sets([x.as_py() for x in batch.column(1)]):
            sizes.append(len(one))
            keys.append(hashlib.blake2b(one.tobytes(), digest_size=16).digest() if len(one) else None)
            sketches.append(registers_of(one).tobytes() if len(one) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary())],
            names=["doc_id", "n_shingles", "set_key", "registers"],
        )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [x.tobytes() for x in shingle_sets([x.as_py() for x in batch.column(1)])]
        keys = [hashlib.blake2b(x, digest_size=16).digest() for x in sets]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], names=["set_key", "shingles"])


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("ra", "rb"))
        n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
        keep = likeliest((a > b).sum(1), (a < b).sum(1), n_a, n_b) >= DOUBT
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _set(value: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=np.uint64)


def _similar(x: np.ndarray, y: np.ndarray, share: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= share * (len(x) + len(y) - both)


def _verified(share: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("sa"), batch.column("sb"), strict=True)
            keep = [_similar(_set(x), _set(y), share) for x, y in pairs]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return check


def _block_links(group: pa.Table, share: int) -> pa.Table:
    """Links that join components, between the strays and the other classes of a group.

    Likely pairs of different components are compared on their full sets, the likeliest first; a link
    makes one component of two, so fewer links than classes leave the task.
    """
    stray, asked = (group.column(c).to_numpy(zero_copy_only=False) for c in ("stray", "asks"))
    rank, parts = (
        np.unique(np.array([x.hex() for x in group.column(c).to_pylist()]), return_inverse=True)[1]
        for c in ("set_key", "component")
    )
    sets = [_set(x) for x in group.column("shingles")]
    r = np.frombuffer(b"".join(group.column("registers").to_pylist()), "<u2").reshape(-1, REGISTERS)
    n = group.column("n_shingles").to_numpy().astype(float)
    strays, others = np.flatnonzero(asked), np.flatnonzero(~asked)
    theirs = np.ascontiguousarray(r[others].T)
    links = []
    # So many strays at once that their counts stay in a core's cache.
    some = max(1, _AT_ONCE // max(len(others), 1))
    for at in range(0, len(strays), some):
        i = strays[at : at + some, None]
        equal = np.zeros((len(i), len(others)), dtype=np.uint8)
        for k in range(REGISTERS):
            equal += r[i, k] == theirs[k]
        near = (equal >= REGISTERS * DOUBT / 2) & (parts[others] != parts[i])
        row, column = np.nonzero(near & (~stray[others] | (rank[i] < rank[others])))
        i, j = i[row, 0], others[column]
        likeness = likeliest((r[i] > r[j]).sum(1), (r[i] < r[j]).sum(1), n[i], n[j])
        order = np.argsort(-likeness, kind="stable")
        for x, y in zip(*(e[order[: (likeness >= DOUBT).sum()]].tolist() for e in (i, j)), strict=True):
            if parts[x] != parts[y] and _similar(sets[x], sets[y], share):
                parts[parts == parts[y]] = parts[x]
                links.append((x, y))
    keys = group.column("set_key")
    a, b = zip(*links, strict=True) if links else ((), ())
    return pa.table({c: pa.array([keys[i].as_py() for i in e], pa.binary()) for c, e in (("a", a), ("b", b))})


def near_duplicates(docs: DataFrame, share: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    ship(docs.sparkSession)
    texts = id_and_bytes(docs, id_col, text_col)
    sketches = stored(
        texts.mapInArrow(_sketch, "doc_id long, n_shingles long, set_key binary, registers binary"), "sketches"
    )
    classes = stored(
        sketches.where("set_key is not null and doc_id is not null").groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "n_shingles", "registers")).alias("x")).select("set_key", "x.*"), "classes",
    )
    width = 2 * ROWS
    band = F.expr(
        f"explode(transform(sequence(0, {BANDS - 1}), i -> xxhash64(i, substring(registers, i * {width} + 1, {width}))))"
    )
    bands = classes.select("set_key", band.alias("band"))
    shared = bands.groupBy("band").agg(F.min("set_key").alias("centre"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = stored(bands.join(shared, "band"), "members")
    chosen = stored(
        classes.join(members.select("set_key").distinct(), "set_key", "left_semi"), "chosen"
    )
    # Most texts are no candidates: ``MARKS`` numbers at most, broadcast, keep them out of the shuffle by id.
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS)).alias("mark")
    wanted = texts.select("*", mark).join(F.broadcast(chosen.select(mark).distinct()), "mark", "left_semi").drop("mark")
    sets = stored(
        wanted.join(chosen.select("doc_id"), "doc_id", "left_semi").mapInArrow(_full_sets, "set_key binary, shingles binary")
        .groupBy("set_key").agg(F.first("shingles").alias("shingles")), "sets",
    )

    def side(df: DataFrame, name: str, value: str, alias: str, *more) -> DataFrame:
        return df.select(F.col("set_key").alias(name), F.col(value).alias(alias), *more)

    def estimated(pairs: DataFrame) -> DataFrame:
        known = pairs.join(side(chosen, "a", "registers", "ra", F.col("n_shingles").alias("na")), "a").join(
            side(chosen, "b", "registers", "rb", F.col("n_shingles").alias("nb")), "b")
        return known.mapInArrow(_likely, "a binary, b binary")

    def confirm(likely: DataFrame) -> DataFrame:
        full = likely.join(side(sets, "a", "shingles", "sa"), "a").join(side(sets, "b", "shingles", "sb"), "b")
        return stored(full.mapInArrow(_verified(share), "a binary, b binary"), "confirmed")

    central = members.where("set_key <> centre").select(F.col("set_key").alias("a"), F.col("centre").alias("b"))
    first = confirm(estimated(central.distinct()))
    groups = components(first)
    placed = members.join(groups.withColumnRenamed("node", "set_key"), "set_key", "left").withColumn(
        "component", F.coalesce("component", "set_key"))
    open_bands = (
        placed.groupBy("band").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.max(F.when(F.col("set_key") == F.col("centre"), F.col("component"))).alias("main"), F.count("*").alias("n"),
        ).where("low <> high").select("band", "main", "n")
    )
    still = placed.drop("centre").join(open_bands, "band").withColumn("stray", F.col("component") != F.col("main"))
    still = stored(still.join(chosen.select("set_key", "n_shingles", "registers"), "set_key"), "open")
    def blocks(which: Column) -> Column:
        """As many as keep a block's classes and its shingles below their bounds."""
        n, held = F.sum(which.cast("long")), F.sum(F.when(which, F.col("n_shingles")))
        return F.greatest(F.ceil(n / BLOCK), F.ceil(held / BLOCK_SHINGLES)).cast("int")

    counts = still.groupBy("band").agg(blocks(F.col("stray")).alias("asking"), blocks(F.lit(True)).alias("asked"))
    still = still.drop("main", "n").join(counts, "band")
    turn = F.abs(F.xxhash64("set_key", F.lit(7)) % F.lit(1 << 30)).cast("int")
    asks = (
        still.where("stray").withColumn("asks", F.lit(True)).withColumn("row", turn % F.col("asking"))
        .withColumn("col", F.explode(F.sequence(F.lit(0), F.col("asked") - 1)))
    )
    answers = (
        still.withColumn("asks", F.lit(False)).withColumn("col", turn % F.col("asked"))
        .withColumn("row", F.explode(F.sequence(F.lit(0), F.col("asking") - 1)))
    )
    columns = ["band", "row", "col", "asks", "stray", "set_key", "component", "n_shingles", "registers"]
    dealt = asks.select(columns).union(answers.select(columns)).join(sets, "set_key")
    links = dealt.groupBy("band", "row", "col").applyInArrow(lambda group: _block_links(group, share), "a binary, b binary")
    second = stored(links, "confirmed")
    groups = components(first.union(second)).withColumnRenamed("node", "set_key")
    ids = sketches.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
    named = classes.select("set_key", "doc_id").join(groups, "set_key", "left").select(
        "set_key", "doc_id", F.coalesce("component", "set_key").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("least"))
    named = named.join(least, "component").select("set_key", "least")
    component = F.coalesce("least", "doc_id")
    return ids.join(named, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )
