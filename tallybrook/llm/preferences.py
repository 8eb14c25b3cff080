"""Preference data: the turns two conversations share as the prompt, and their different ends as completions.

The operator takes pairs of conversations. The two are compared turn by turn at equal positions; the first
position where they differ, or where one has ended, ends their common prefix. Turns before it are
rendered once, as ``prompt``; the others as ``chosen`` and ``rejected``. ``trained`` masks: only
assistant turns of completions are trained on. One row comes out for each rendered turn, so a conversation of any
length is never gathered; ordered by ``turn`` and ``tie``, the rows of a part make its text.

Where the data name no pairs, conversations that open with the same turn are
paired by ascending id, first within ``SALTS`` hashed shares of the group and then, for those left over, among the shares.
The lower id is the chosen one. An opening that a third of all conversations have is so spread over tasks.

Each conversation that is left over and has an assistant turn behind its first position is the chosen side of a pair of its own. The rejected
side is the same conversation with its last assistant turn taken from another one that is left over, so all before that turn is prompt;
``rejected_id`` names the donor. Conversations are ranked by what that turn says, and the donor is so many ranks on that
its turn says something else wherever one does. The others are paired by rank among themselves, and their prompt is empty; at
most one stays alone. Ranks are row numbers within ranges of rows plus the sizes of the ranges before.

Defined results: rows without a conv_id are left out; a null turn comes before turn 0; rows of one turn are ordered
by role and text, and repeated ones stay; null role or text renders as empty; of equal conversations all is
prompt; the lowest id of an odd number of the others gives no rows; an empty table gives none.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallybrook.llm.common import stored

SALTS = 256


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n"))


def _placed(turns: DataFrame) -> DataFrame:
    """conv_id, turn, tie, role, text, at: the rows of a conversation in order of ``at``."""
    tie = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text")) - 1
    rows = turns.where("conv_id is not null").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", tie.alias("tie"))
    return rows.withColumn("at", F.struct(F.coalesce("turn", F.lit(-(1 << 62))).alias("turn"), "tie"))


def _ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``rank`` from 0 in the order of columns that tell all rows apart."""
    ranges = stored(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range.
    offsets = ranges.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    return ranges.withColumn("inside", inside).join(offsets, "range").withColumn("rank", F.col("offset") + F.col("inside")).drop(
        "range", "inside", "offset")


def _by_rank(alone: DataFrame) -> DataFrame:
    """Pairs from the highest id down."""
    ranked = _ranked(alone.select("conv_id", (-F.col("conv_id")).alias("down")), "down")
    return ranked.groupBy(F.floor(F.col("rank") / 2).alias("nth")).agg(
        F.min("conv_id").alias("chosen_id"), F.max("conv_id").alias("rejected_id"), F.count("*").alias("n"),
    ).where("n = 2").select("chosen_id", "rejected_id")


def _same_opening(turns: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    """Pairs, and the conversations left over."""
    opening = turns.where("conv_id is not null").groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text")).alias("x"))
    heads = opening.select("conv_id", F.sha2(F.to_json(F.struct("x.role", "x.text")), 256).alias("head"))
    heads = heads.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(salts)))

    def paired(rows: DataFrame, keys: list[str]) -> DataFrame:
        nth = F.floor((F.row_number().over(Window.partitionBy(*keys).orderBy("conv_id")) - 1) / 2)
        return rows.withColumn("nth", nth).groupBy(*keys, "nth").agg(
            F.min("conv_id").alias("chosen_id"), F.max("conv_id").alias("rejected_id"), F.count("*").alias("n"))

    first = stored(paired(heads, ["head", "salt"]), "paired")
    second = stored(paired(first.where("n = 1").select("head", F.col("chosen_id").alias("conv_id")), ["head"]), "paired")
    both = [x.where("n = 2").select("chosen_id", "rejected_id") for x in (first, second)]
    return both[0].union(both[1]), second.where("n = 1").select(F.col("chosen_id").alias("conv_id"))


def pair_by_first_turn(turns: DataFrame, salts: int = SALTS) -> DataFrame:
    """chosen_id, rejected_id; those without a common opening by rank."""
    pairs, alone = _same_opening(turns, salts)
    return pairs.union(_by_rank(alone))


def swap_last_answer(turns: DataFrame, alone: DataFrame) -> DataFrame:
    """chosen_id, rejected_id (the donor), at (the place that changes), donor_at."""
    says = F.struct("at", F.sha2(F.to_json(F.struct("text")), 256).alias("says"))
    last = _placed(turns).join(alone, "conv_id", "left_semi").groupBy("conv_id").agg(
        F.min("at").alias("start"), F.max(F.when(F.col("role") == "assistant", says)).alias("last"))
    able = last.where(F.col("last.at") > F.col("start")).select("conv_id", "last.at", "last.says")
    ranked = stored(_ranked(able, "says", "conv_id"), "ranked")
    kinds = ranked.groupBy("says").agg(F.count("*").alias("n"), F.min("rank").alias("start"))
    top = kinds.agg(F.sum("n").alias("n"), F.max(F.struct("n", "start")).alias("most")).first()
    n = top["n"] or 0
    most, start = (top["most"]["n"], top["most"]["start"]) if n else (0, 0)
    rank = F.col("rank")
    if 2 * most <= n or most == n:
        # Equal turns lie side by side, ``most`` of them at the most; where all are equal, the next.
        donor = F.pmod(rank + (most if most < n else 1), F.lit(max(n, 1)))
    else:
        # More than half say the same: they share the donors of the others, who take theirs from them.
        common = (rank >= start) & (rank < start + most)
        donor = F.when(common, F.pmod(start + most + F.pmod(rank - start, F.lit(n - most)), F.lit(n))).otherwise(
            start + F.pmod(rank - start - most, F.lit(n)))
    donors = ranked.select(F.col("rank").alias("donor"), F.col("conv_id").alias("rejected_id"), F.col("at").alias("donor_at"))
    return ranked.withColumn("donor", donor).withColumnRenamed("conv_id", "chosen_id").join(donors, "donor").where(
        "chosen_id <> rejected_id").select("chosen_id", "rejected_id", "at", "donor_at")


def format_pairs(turns: DataFrame, pairs: DataFrame, swaps: DataFrame | None = None) -> DataFrame:
    """pair_id, rejected_id, part, turn, tie, role, rendered, trained."""
    placed = _placed(turns)
    names = ["pair_id", "rejected_id", "part", "at", "turn", "tie", "role", "text"]
    sides = pairs.select(
        F.col("chosen_id").alias("pair_id"), "rejected_id",
        F.explode(F.array(
            F.struct(F.lit("chosen").alias("part"), F.col("chosen_id").alias("conv_id")),
            F.struct(F.lit("rejected").alias("part"), F.col("rejected_id").alias("conv_id")))).alias("s"),
    ).select("pair_id", "rejected_id", "s.*")
    rows = sides.join(placed, "conv_id").select(*names)
    if swaps is not None:
        swaps = swaps.withColumnRenamed("chosen_id", "pair_id").withColumnRenamed("at", "swap")
        own = swaps.join(placed, F.col("pair_id") == F.col("conv_id"))
        parts = F.when(F.col("at") == F.col("swap"), F.array(F.lit("chosen"))).otherwise(F.array(F.lit("chosen"), F.lit("rejected")))
        other = swaps.join(placed, (F.col("rejected_id") == F.col("conv_id")) & (F.col("donor_at") == F.col("at")))
        other = other.withColumn("at", F.col("swap")).withColumn("tie", F.col("swap.tie")).withColumn("part", F.lit("rejected"))
        # The place of a null turn has a number that no turn should show.
        other = other.withColumn("turn", F.when(F.col("swap.turn") > -(1 << 62), F.col("swap.turn")))
        rows = rows.union(own.withColumn("part", F.explode(parts)).select(*names)).union(other.select(*names))
    content = F.struct("role", "text")
    met = rows.groupBy("pair_id", "rejected_id", "at").agg(
        F.max(F.when(F.col("part") == "chosen", content)).alias("c"), F.max(F.when(F.col("part") == "rejected", content)).alias("r"))
    # A struct of nulls is itself not null, so a turn that is missing on one side differs.
    cuts = met.groupBy("pair_id", "rejected_id").agg(F.min(F.when(~F.col("c").eqNullSafe(F.col("r")), F.col("at"))).alias("cut"))
    split = rows.join(cuts, ["pair_id", "rejected_id"]).withColumn("shared", F.coalesce(F.col("at") < F.col("cut"), F.lit(True)))
    return split.where("part = 'chosen' or not shared").select(
        "pair_id", "rejected_id", F.when(F.col("shared"), "prompt").otherwise(F.col("part")).alias("part"), "turn", "tie", "role",
        render(F.col("role"), F.col("text")).alias("rendered"),
        F.coalesce(~F.col("shared") & (F.col("role") == "assistant"), F.lit(False)).alias("trained"),
    )


def format_preferences(turns: DataFrame, salts: int = SALTS) -> DataFrame:
    pairs, alone = _same_opening(turns, salts)
    swaps = stored(swap_last_answer(turns, alone), "swaps")
    rest = alone.join(swaps.select(F.col("chosen_id").alias("conv_id")), "conv_id", "left_anti")
    return format_pairs(turns, pairs.union(_by_rank(rest)), swaps)
