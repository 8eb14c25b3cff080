"""The trie of conversations' common beginnings, by burst tries over shards of suffix containers.

Conversations are sequences of turns; a turn is known by the digest of its role and text. Sequences are cut in stretches of
``SPAN`` turns, each under the trie head of all turns before it, so no row holds more than ``SPAN`` turns. Conversations
that agree up to the end of a stretch are one suffix there. The suffixes below one head are a container. One with more than
``LIMIT`` suffixes bursts: each suffix moves on by its next turn into the container of the head that this turn makes. What
is left is dealt over shards; each shard sorts its containers and sweeps over them once, which gives
their nodes with counts and subtree sums. Heads take the sums of their containers, from the deepest burst to the first
and from the last stretch to the first. Below a head that only equal conversations pass, no trie is needed: the rows of the
least of them are the nodes. So there are as many rounds as stretches that different conversations share, however
long the longest one is.

The digest of the members that end at a node takes their ids in ascending order. These are sorted by ranges, joined
into strings of ``PIECE`` ids, and the strings of a node are hashed one after another as they arrive; a SHA-256 can't be
computed in parts, so the strings (not the rows) of one node go through one task, in bounded memory.

Defined results: rows without a conv_id are left out; a null turn comes first; rows of one turn are ordered by role and
the digest of their text, and repeated ones stay; null role or text is empty; other columns are ignored; an empty table gives no
rows, not even a root.
"""

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallybrook.llm.common import ship, stored

SPAN = 64
LIMIT = 2048
SHARD = 8192
PIECE = 4096
HEAD_TURNS = 5
SLICE = 4096
ROOT = "0:0:0"
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "end string"
)
SWEPT = f"key string, {NODES}"
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), id, size: one conversation may span many ranges of rows."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("id"),
        F.length(text).cast("long").alias("size"),
    )
    order = ["conv_id", "turn", "role", "id"]
    rows = stored(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "turns")
    parts = rows.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each conversation and range it has rows in.
    parts = parts.select("conv_id", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy("turn", "role", "id"))
    return rows.withColumn("inside", inside).join(parts, ["conv_id", "range"]).select(
        "conv_id", (F.col("offset") + F.col("inside")).alias("pos"), "id", "size")


def share_heads(turns: DataFrame, group: int = 100) -> tuple[DataFrame, DataFrame]:
    """Every conversation rebuilt on the first turns of the first one of its group; and all conv_ids."""
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD_TURNS + 1)
    convs = own.select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("head"), taken.alias("h"))
    sizes = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("head"), F.col("n").alias("there"))
    convs = stored(convs.join(sizes, "head", "left").withColumn("k", F.least("h", F.coalesce("there", F.lit(0)))), "convs")
    # At most five rows for each conversation, and at most ``group`` conversations for each head.
    heads = turns.where((F.col("pos") <= HEAD_TURNS) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "head")
    first = convs.join(heads, "head").where("pos <= h").select("conv_id", "pos", "id", "size")
    rest = turns.join(convs.select("conv_id", "h", "k"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "id", "size")
    return first.union(rest), convs.select("conv_id")


def _path(length: Column, first: Column, second: Column) -> Column:
    return F.concat_ws(":", length.cast("string"), first.cast("string"), second.cast("string"))


def stretches(turns: DataFrame, span: int) -> DataFrame:
    """conv_id, block, head and end (the paths before and behind it), ids, sizes, closes: whether it is the last."""
    turn = F.struct("pos", "id", "size")
    # A path is known by its length and two sums (xor) over its turns and their places.
    blocks = turns.groupBy("conv_id", F.floor((F.col("pos") - 1) / span).alias("block")).agg(
        F.sort_array(F.collect_list(turn)).alias("t"), F.bit_xor(F.xxhash64("pos", "id")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit("second"), "id", "pos")).alias("y"))
    so_far = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = blocks.withColumns({
        "to": F.sum(F.size("t")).over(so_far), "tx": F.bit_xor("x").over(so_far), "ty": F.bit_xor("y").over(so_far),
        "closes": F.lead("block").over(Window.partitionBy("conv_id").orderBy("block")).isNull(),
    })
    return blocks.select(
        "conv_id", "block",
        _path(F.col("to") - F.size("t"), F.col("tx").bitwiseXOR(F.col("x")), F.col("ty").bitwiseXOR(F.col("y"))).alias("head"),
        _path(F.col("to"), F.col("tx"), F.col("ty")).alias("end"),
        F.col("t.id").alias("ids"), F.col("t.size").alias("sizes"), "closes")


def end_digests(ends: DataFrame) -> DataFrame:
    """``ends`` (end, conv_id) to end, ends_sha256."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        def piece(rows_of: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=k) for c, k in zip(zip(*rows_of), (pa.string(), pa.int64(), pa.string()))],
                names=["end", "first", "piece"])

        done, now, ids = [], None, []
        for end, conv in rows():
            if ids and (end != now or len(ids) >= PIECE):
                done.append((now, ids[0], ",".join(map(str, ids))))
                ids = []
                if len(done) >= 1000:
                    yield piece(done)
                    done = []
            now = end
            ids.append(conv)
        if ids:
            done.append((now, ids[0], ",".join(map(str, ids))))
        if done:
            yield piece(done)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, done = None, None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in done], pa.string()), pa.array([x for _, x in done], pa.string())], names=["end", "ends_sha256"])

        for batch in batches:
            for end, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if end != now:
                    if sha is not None:
                        done.append((now, sha.hexdigest()))
                    now, sha = end, hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
            if len(done) >= 10_000:
                yield out()
                done = []
        if sha is not None:
            done.append((now, sha.hexdigest()))
        yield out()

    ranged = ends.select("end", "conv_id").repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    pieces = ranged.mapInArrow(join, "end string, first long, piece string")
    return pieces.repartition("end").sortWithinPartitions("end", "first").mapInArrow(digest, "end string, ends_sha256 string")


class _Node:
    __slots__ = ("parent", "depth", "size", "conv", "n", "children", "leaves", "saved", "end")

    def __init__(self, parent: "_Node | None", depth: int, size: int, conv: int | None = None):
        self.parent, self.depth, self.size, self.conv = parent, depth, size, conv
        self.n = self.children = self.leaves = self.saved = 0
        self.end = None


def sweep(container: list[dict]) -> Iterator[tuple]:
    """Node rows of one container, and its head's row (without conv_id) with what stands below it."""
    container.sort(key=lambda x: x["ids"][x["skip"] :])
    nodes = [_Node(None, 0, 0, container[0]["head_conv"])]
    path, before = nodes[:1], []
    for item in container:
        ids, sizes, skip = item["ids"], item["sizes"], item["skip"]
        shared = 0
        while skip + shared < min(len(ids), len(before)) and ids[skip + shared] == before[skip + shared]:
            shared += 1
        del path[shared + 1 :]
        for at in range(skip + shared, len(ids)):
            path.append(_Node(path[-1], item["depth"] + at + 1, sizes[at]))
            nodes.append(path[-1])
        for node in path[1:]:
            node.n += item["n"]
            node.conv = item["conv"] if node.conv is None else min(node.conv, item["conv"])
        last = path[-1]
        last.end = item["end"] if item["ended"] else None
        last.children, last.leaves, last.saved = item["children"], item["leaves"], item["saved"]
        before = ids
    # A node is made after its parent, so backwards the sums below it are known.
    for node in reversed(nodes[1:]):
        node.leaves = node.leaves if node.children else 1
        node.saved += (node.n - 1) * node.size
        up = node.parent
        up.children, up.leaves, up.saved = up.children + 1, up.leaves + node.leaves, up.saved + node.saved
    for node in nodes[1:]:
        yield None, node.conv, node.depth, node.parent.conv, node.n, node.children, node.leaves, node.saved, node.end
    head = nodes[0]
    yield container[0]["key"], None, None, None, None, head.children, head.leaves, head.saved, head.end


def _sweep_shard(shard: pa.Table) -> pa.Table:
    kinds = [pa.string()] + [pa.int64()] * 7 + [pa.string()]
    names = [x.split()[0] for x in SWEPT.split(", ")]
    items = sorted(shard.to_pylist(), key=lambda x: x["key"])
    rows = [row for _, same in groupby(items, key=lambda x: x["key"]) for row in sweep(list(same))]
    return pa.table([pa.array(list(c), type=k) for c, k in zip(zip(*rows), kinds)], names=names)


def _sums(rows: DataFrame) -> DataFrame:
    """One row for each head: what its containers and the heads below it say."""
    return rows.groupBy("key").agg(
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.max("end").alias("end"))


def containers_to_nodes(items: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Burst, sweep and sum up the suffixes of one block; nodes below the heads, and a row (key) for each head."""
    now, ready, bursts = stored(items.withColumn("skip", F.lit(0)), "containers"), [], []
    while True:
        sizes = now.groupBy("key").agg(F.count("*").alias("held"))
        large = stored(sizes.where(F.col("held") > limit).drop("held"), "oversized")
        if large.isEmpty():
            ready.append(now)
            break
        over = F.col("skip") < F.size("ids")
        ready.append(now.join(large, "key", "left_anti"))
        bursting = now.join(large, "key", "left_semi")
        # A suffix that ends at the head itself stays with it.
        ready.append(bursting.where(~over))
        moved = bursting.where(over).withColumns({
            "up": F.col("key"), "up_conv": F.col("head_conv"), "size": F.element_at("sizes", F.col("skip") + 1),
            "key": F.md5(F.concat(F.col("key"), F.hex(F.element_at("ids", F.col("skip") + 1)))),
        }).withColumn("skip", F.col("skip") + 1)
        heads = stored(moved.groupBy("key").agg(
            F.min("up").alias("up"), F.min("up_conv").alias("parent_conv_id"), F.min("conv").alias("conv_id"), F.sum("n").alias("n_convs"),
            F.max("size").alias("size"), F.max(F.col("depth") + F.col("skip")).alias("depth")), "heads")
        bursts.append(heads)
        now = stored(moved.drop("up", "up_conv", "size", "head_conv").join(
            heads.select("key", F.col("conv_id").alias("head_conv")), "key").select(*now.columns), "containers")
    suffixes = ready[0]
    for more in ready[1:]:
        suffixes = suffixes.unionByName(more)
    suffixes = stored(suffixes, "suffixes")
    shards = suffixes.count() // SHARD + 1
    ship(items.sparkSession)
    swept = stored(suffixes.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("shard").applyInArrow(
        _sweep_shard, SWEPT), "swept")
    names = [x.split()[0] for x in NODES.split(", ")]
    nodes, tops = [swept.where("key is null").select(*names)], swept.where("key is not null").select(
        "key", "n_children", "n_leaves", "saved_tokens", "end")
    for heads in reversed(bursts):
        known = stored(_sums(tops), "sums")
        own = heads.join(known, "key").withColumns({
            "n_leaves": F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size"),
        })
        own = stored(own, "burst")
        nodes.append(own.select(*names))
        above = own.select(
            F.col("up").alias("key"), F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("end"))
        tops = known.join(heads.select("key"), "key", "left_anti").unionByName(above)
    all_nodes = nodes[0]
    for more in nodes[1:]:
        all_nodes = all_nodes.unionByName(more)
    return all_nodes, stored(_sums(tops), "tops")


def trie(turns: DataFrame, convs: DataFrame, span: int = SPAN, limit: int = LIMIT) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv_id, pos, id, size); ``convs`` has all conv_ids, also those without turns."""
    turns = stored(turns, "sequences")
    blocks = stored(stretches(turns, span), "stretches")
    closed = blocks.where("closes").select("conv_id", F.col("end").alias("path"))
    paths = stored(convs.join(closed, "conv_id", "left").select("conv_id", F.coalesce("path", F.lit(ROOT)).alias("path")), "paths")
    ended = stored(end_digests(paths.withColumnRenamed("path", "end")), "ends")
    # Equal stretches below equal heads are one suffix.
    same = blocks.join(paths, "conv_id").groupBy("block", "head", "end").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv"), F.max("closes").alias("ended"),
        F.min("path").alias("least"), F.max("path").alias("most"), F.first("ids").alias("ids"), F.first("sizes").alias("sizes"))
    same = stored(same, "suffixes")
    # Heads that conversations of one kind pass only; the root is kept whatever passes it.
    lone = stored(same.where("block > 0").groupBy("head").agg(
        F.min("least").alias("least"), F.max("most").alias("most"), F.min("conv").alias("conv"), F.max("n").alias("n"),
    ).where("least = most").select("head", "conv", "n", F.col("least").alias("path")), "lone")
    shared = stored(same.drop("least", "most").join(lone.select("head"), "head", "left_anti"), "shared")
    top = paths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")).first()
    if not top["n"]:
        return turns.sparkSession.createDataFrame([], NODES).drop("end").withColumn("ends_sha256", F.lit(""))
    deepest = shared.agg(F.max("block")).first()[0]
    node_tables, below = _tails(turns, shared, lone, span)
    for block in range(-1 if deepest is None else deepest, -1, -1):
        items = shared.where(F.col("block") == block).join(
            below.select(F.col("key").alias("end"), "n_children", "n_leaves", "saved_tokens"), "end", "left")
        if block:
            heads = shared.where(F.col("block") == block - 1).select(F.col("end").alias("head"), F.col("conv").alias("head_conv"))
            items = items.join(heads, "head")
        else:
            items = items.withColumn("head_conv", F.lit(top["conv_id"]).cast("long"))
        zero = F.lit(0).cast("long")
        items = items.select(
            F.col("head").alias("key"), "head_conv", F.lit(block * span).cast("long").alias("depth"), "conv", "n", "ids", "sizes", "end", "ended",
            F.coalesce("n_children", zero).alias("children"), F.coalesce("n_leaves", zero).alias("leaves"),
            F.coalesce("saved_tokens", zero).alias("saved"))
        nodes, tops = containers_to_nodes(items, limit)
        node_tables.append(nodes)
        # Lone heads of the block above stay known beside the heads just made.
        below = below.unionByName(tops.select(*below.columns)) if block else tops
    known = below.where(F.col("key") == ROOT).first()
    children, leaves, saved = (known["n_children"], known["n_leaves"], known["saved_tokens"]) if known else (0, 1, 0)
    node_tables.append(turns.sparkSession.createDataFrame(
        [(top["conv_id"], 0, None, top["n"], children, leaves, saved, ROOT)], NODES))
    nodes = node_tables[0]
    for more in node_tables[1:]:
        nodes = nodes.unionByName(more)
    return nodes.join(ended, "end", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"))


def _tails(turns: DataFrame, shared: DataFrame, lone: DataFrame, span: int) -> tuple[list[DataFrame], DataFrame]:
    """Nodes below lone heads that follow a shared stretch, and what such a head has below it."""
    above = shared.select(F.col("end").alias("head"), F.col("conv").alias("above"), ((F.col("block") + 1) * span).alias("from"))
    tails = above.join(lone, "head").withColumn("last", F.substring_index("path", ":", 1).cast("long"))
    rows = turns.join(tails.withColumnRenamed("conv", "conv_id"), "conv_id").where(F.col("pos") > F.col("from"))
    rows = stored(rows.withColumn("slice", F.floor(F.col("pos") / SLICE)), "tail-turns")
    # One row for each conversation and ``SLICE`` turns; then running sums within those.
    after = Window.partitionBy("conv_id").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("conv_id", "slice").agg(F.sum("size").alias("sum")).select(
        "conv_id", "slice", F.coalesce(F.sum("sum").over(after), F.lit(0)).alias("later"))
    inside = F.sum("size").over(
        Window.partitionBy("conv_id", "slice").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("inside", inside).join(parts, ["conv_id", "slice"])
    saved = ((F.col("n") - 1) * (F.col("inside") + F.col("later"))).alias("saved_tokens")
    first, last = F.col("pos") == F.col("from") + 1, F.col("pos") == F.col("last")
    nodes = rows.select(
        "conv_id", F.col("pos").alias("depth"), F.when(first, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), saved, F.when(last, F.col("path")).alias("end"))
    one = F.lit(1).cast("long")
    tops = rows.where(first).select(F.col("head").alias("key"), one.alias("n_children"), one.alias("n_leaves"), saved)
    return [nodes], stored(tops, "tail-heads")


def prefix_trie(conversations: DataFrame, span: int = SPAN, limit: int = LIMIT, group: int = 100) -> DataFrame:
    turns, convs = share_heads(stored(ordered_turns(conversations), "ordered"), group)
    return trie(turns, convs, span, limit)
