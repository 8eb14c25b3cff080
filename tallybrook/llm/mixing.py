"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources get targets in words; a source's target over its size gives complete epochs, which take every document
once each, and a remainder. The remainder goes to documents in ascending order of an exponential
key, -ln(u) over the document's quality weight, with u from a hash of its id, until the words are used up; the document
in which they end is taken in part. So reruns agree.

A source is never sorted in one task: keys fall into ranges, whose word totals are summed first, and documents are
only sorted within their range. Ranges are even in the key's logarithm, ``FINE`` to a factor of e: whatever the
weights, a range expects at most 1 / (e * FINE) of a source's documents, about 0.3 %. The table of sources has one row each and
is the only thing that is ordered as a whole.

Defined results: a null text has size 0; documents of size 0 take nothing; a null source is a source, the last; equal
keys are ordered by id and size, so repeated rows are interchangeable; an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallybrook.llm.common import WORD, stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
FINE = 128
LEAST_KEY, MOST_KEY = -7, 6
SEED = 20_011


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def quality_weight(text: Column) -> Column:
    """The squared share of letters and white space, at least 0.05."""
    plain = F.length(F.regexp_replace(text, r"[^\p{L}\x20\x09-\x0D]+", ""))
    share = F.coalesce(plain / F.greatest(F.length(text), F.lit(1)), F.lit(0.0))
    return F.greatest(F.lit(0.05), share * share)


def slot_of(key: Column) -> Column:
    """Keys beyond the logarithms ``LEAST_KEY`` (at most 0.1 % of documents) and ``MOST_KEY`` share the outermost slots."""
    slot = F.floor((F.log(key) - LEAST_KEY) * FINE)
    return F.least(F.greatest(slot, F.lit(0)), F.lit((MOST_KEY - LEAST_KEY) * FINE - 1)).cast("int")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: level by weight, cut at ``most`` times the size.

    Sources are filled in the order in which they reach their bound. The level that the rest would
    get rises while full sources leave and falls after, so it is the highest one.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("bound", most * F.col("source_size"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = F.max(F.col("level")).over(everything)
    return rows.withColumn("level", left / rest).withColumn("level", level).select(
        "source", "source_size", F.least(F.col("bound"), F.col("level") * F.col("weight")).alias("target"))


def mix(
    docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST,
    weight: Column | None = None, seed: int = SEED, keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, size, source_size, target, taken, and the columns of ``keep``, which may be all of ``docs``."""
    text = F.col("text").cast("string")
    drawn = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11) + F.lit(0.5)) * F.lit(2.0**-53)
    key = -F.log(drawn) / (quality_weight(text) if weight is None else weight)
    rows = docs.select(
        *(F.col(f"`{c}`").alias(f"_in_{c}") for c in keep), F.col("doc_id"), F.col("source").cast("string").alias("source"),
        words(text).alias("size"), key.alias("key"),
    ).withColumn("slot", slot_of(F.col("key")))
    slots = stored(rows.groupBy("source", "slot").agg(F.sum("size").alias("words")), "slots")
    targets = source_targets(slots.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    earlier = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each source and slot; a file of known size, broadcast only below the session's bound.
    table = stored(
        slots.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words").alias("s")
        .join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
        .select(F.col("s.source").alias("_source"), F.col("s.slot").alias("_slot"), "offset", "source_size", "target"), "offsets")
    joined = rows.join(table, F.col("source").eqNullSafe(F.col("_source")) & (F.col("slot") == F.col("_slot")))
    inside = Window.partitionBy("source", "slot").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    epochs = F.coalesce(F.floor(F.try_divide("target", F.col("source_size").cast("double"))), F.lit(0)).cast("long")
    budget = F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), budget - F.col("before")))
    return (
        joined.withColumn("before", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .withColumn("epochs", epochs)
        .select(
            "doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
            *(f"_in_{c}" for c in keep))
    )


def repeat_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, the last time perhaps only their first words."""
    mixed = mix(docs, keep=tuple(docs.columns), **settings).where("taken > 0")
    text = F.col("_in_text")
    copies, rest = F.floor(F.col("taken") / F.col("size")).cast("int"), (F.col("taken") % F.col("size")).cast("int")
    gaps = F.split(text, WORD, -1)
    first = F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, F.greatest(rest, F.lit(1)))
    start = F.array_join(F.zip_with(F.slice(gaps, 1, F.greatest(rest, F.lit(1))), first, lambda gap, word: F.concat(gap, word)), "")
    texts = F.concat(F.array_repeat(text, copies), F.when(rest > 0, F.array(start)).otherwise(F.array().cast("array<string>")))
    out = mixed.withColumn("_text", F.explode(texts))
    return out.select(*((F.col("_text") if c == "text" else F.col(f"`_in_{c}`")).alias(c) for c in docs.columns))
