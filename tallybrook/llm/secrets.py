"""Secrets in texts, and multipart credentials by an interval join of their parts.

Strong parts are reported wherever they stand: ``assign``, ``access`` and ``hex``. Weak parts, ``ident`` (a
named account), ``bare`` (a mixed string of 20 or more
characters, or the value of a key such as secret_access_key, dots included) and ``endpoint``
(a URL of any scheme, or host and port), are only reported where complementary parts lie within ``SCOPE`` code points: a weak identifier or secret beside a strong
part of the other role, or all three roles together. The parts of a text are joined as intervals by looking, for
every part, for the nearest part of each role before and behind it, so that no pairs are listed.

Positions come from the pieces between the matches of a kind: the lengths of the pieces and matches before it
add up to a match's start. Only lengths and matches are shuffled, not texts.

Defined results: a null text is empty; an empty text or one without matches has zeros and an empty list; repeated rows are
reported each; a weak part that overlaps a strong one is not reported; an empty table gives no rows; other columns
are ignored, and ``redact`` keeps them.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

# The patterns of the strong kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
IDENT = r"""(?i)(?:user(?:_?name|_?id)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
# The value of a key whose name says that it is secret, or a string in which digits and both cases are mixed, perhaps with
# long further parts behind dots as signed and encrypted tokens have (three or five in all), up to padding and the end of a
# sentence. They may be of any length; only strings of forty characters may begin with a slash, as paths do.
_TOKEN = "[A-Za-z0-9+/_-]"
_ENDS = r"={0,2}(?![A-Za-z0-9+/_-]|[.=][A-Za-z0-9+/_=-])"
# Looks back for the sign alone first, as blanks are many and names cost more.
NAMED = (
    r"""(?<=[:="'\x20])(?<=[:=]\x20{0,2}["']{0,1})(?<=(?i:(?:secret|private|signing|encryption|account|shared|master|auth)[_-]?(?:access[_-]?)?key|pwd|passphrase)["']{0,1}\x20{0,2}[:=]\x20{0,2}["']{0,1})"""
    r"(?=[+/_.=-]*[A-Za-z0-9])[A-Za-z0-9+/_.=-]{8,}(?<!\.)")
MIXED = (
    rf"(?<![A-Za-z0-9+/_.-])(?={_TOKEN}*[0-9])(?={_TOKEN}*[a-z])(?={_TOKEN}*[A-Z])"
    rf"(?:[A-Za-z0-9+/]{{40}}|[A-Za-z0-9+]{_TOKEN}{{19,}}(?:\.{_TOKEN}{{16,}}){{0,4}}){_ENDS}")
BARE = f"(?:{NAMED}|{MIXED})"
# A URL of any scheme, perhaps with a login, or a host with its port; a key with a number is no host.
ENDPOINT = (
    r"""(?:[A-Za-z][A-Za-z0-9+.-]{0,20}://(?:[^\s/@"'<>]++@)?[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~/-]*)?"""
    r"|(?<![A-Za-z0-9._@:/-])(?:[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z0-9-]+:[0-9]{2,5}"
    r"|(?!(?i:user|login|account|client|access|pass|pwd|secret|token|api|id:|key))[A-Za-z][A-Za-z0-9-]{0,62}:[0-9]{4,5})(?![A-Za-z0-9]))")
KINDS = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("ident", IDENT), ("bare", BARE), ("endpoint", ENDPOINT))
ROLE = "element_at(array('secret', 'id', 'secret', 'id', 'secret', 'endpoint'), kind + 1)"
SCOPE = 400
MARK = "[SECRET]"


def _matches(text: Column, kind: int, pattern: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    # Zipped, as a lambda that looks into an array would cut the text again for each match.
    pairs = F.filter(F.zip_with(found, gaps, lambda m, gap: F.struct(m.alias("m"), gap.alias("gap"))), lambda x: x["m"].isNotNull())
    parts = F.transform(pairs, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("nth"), x["gap"].alias("gap"), F.length(x["m"]).alias("length"),
        (F.length(F.regexp_extract(x["m"], pattern, 2)) >= 8 if kind == 0 else F.lit(True)).alias("holds")))
    return F.when(text.rlike(pattern), parts).otherwise(F.array().cast("array<struct<kind:int,nth:int,gap:int,length:int,holds:boolean>>"))


def _spans(rows: DataFrame, keys: list[str], scope: int) -> DataFrame:
    """``rows`` (keys, text) to one row each with ``found``, its spans in order."""
    every = F.concat(*(_matches(F.col("text"), i, p) for i, (_, p) in enumerate(KINDS)))
    each = rows.withColumn("row", F.monotonically_increasing_id()).select("row", *keys, F.explode_outer(every).alias("m")).select("row", *keys, "m.*")
    whole = F.sum(F.col("gap") + F.col("length")).over(Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0))
    spans = each.withColumn("end", whole).withColumn("start", F.col("end") - F.col("length"))
    spans = spans.where("kind is null or holds").withColumn("role", F.expr(ROLE))
    ahead = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(1, Window.unboundedFollowing)
    strong = F.col("kind") < 3

    def nearest(which: Column) -> Column:
        back = F.col("start") - F.max(F.when(which, F.col("end"))).over(ahead) <= scope
        on = F.min(F.when(which, F.col("start"))).over(behind) - F.col("end") <= scope
        return F.coalesce(back, F.lit(False)) | F.coalesce(on, F.lit(False))

    covered = (
        F.coalesce(F.max(F.when(strong, F.col("end"))).over(ahead) > F.col("start"), F.lit(False))
        | F.coalesce(F.min(F.when(strong, F.col("start"))).over(behind) < F.col("end"), F.lit(False))
    )
    joined = spans.select(
        "row", *keys, "kind", "start", "end", covered.alias("covered"),
        nearest(F.col("role") == "id").alias("by_id"), nearest((F.col("role") == "id") & strong).alias("by_strong_id"),
        nearest(F.col("role") == "secret").alias("by_secret"), nearest((F.col("role") == "secret") & strong).alias("by_strong_secret"),
        nearest(F.col("role") == "endpoint").alias("by_endpoint"),
    )
    linked = (
        F.when(F.col("kind") < 3, True)
        .when(F.col("covered"), False)
        .when(F.col("kind") == 3, F.expr("by_strong_secret or (by_secret and by_endpoint)"))
        .when(F.col("kind") == 4, F.expr("by_strong_id or (by_id and by_endpoint)"))
        .when(F.col("kind") == 5, F.expr("by_id and by_secret"))
    )
    span = F.when(linked, F.struct("start", "kind", "end"))
    return joined.groupBy("row", *keys).agg(F.array_sort(F.collect_list(span)).alias("found")).drop("row")


def _named(found: Column) -> Column:
    names = ", ".join(f"'{n}'" for n, _ in KINDS)
    return F.concat_ws(",", F.transform(found, lambda x: F.concat_ws(
        ":", F.element_at(F.expr(f"array({names})"), x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))))


def find_secrets(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    found = F.col("found")

    def count(kind: int) -> Column:
        return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")

    return _spans(rows, ["doc_id"], scope).select(
        "doc_id", *(count(i).alias(f"n_{KINDS[i][0]}") for i in range(3)),
        F.sha2(_named(F.filter(found, lambda x: x["kind"] < 3)), 256).alias("base_sha256"),
        _named(found).alias("spans"), F.size(F.filter(found, lambda x: x["kind"] > 2)).cast("long").alias("n_linked"),
    )


def redact(docs: DataFrame, scope: int = SCOPE, mark: str = MARK) -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``mark``; no row is left out."""
    # Under names of our own, so that no column of the table's meets one of the search's.
    own = {c: f"_in_{i}" for i, c in enumerate(docs.columns)}
    body = F.col(own["text"])
    inner = docs.select(*(F.col(f"`{c}`").alias(name) for c, name in own.items()))
    key = F.sha2(body, 256)
    rows = inner.where(body.isNotNull()).select(key.alias("_key"), body.alias("text"))
    hits = _spans(rows, ["_key"], scope).where(F.size("found") > 0).dropDuplicates(["_key"])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(done: Column, x: Column) -> Column:
        fresh = x["start"] >= done["at"]
        between = F.substring(body, (done["at"] + 1).cast("int"), (x["start"] - done["at"]).cast("int"))
        return F.struct(
            F.greatest(done["at"], x["end"]).alias("at"),
            F.when(fresh, F.concat(done["out"], between, F.lit(mark))).otherwise(done["out"]).alias("out"))

    def close(done: Column) -> Column:
        return F.concat(done["out"], F.substring(body, (done["at"] + 1).cast("int"), F.length(body)))

    text = F.when(F.col("found").isNull(), body).otherwise(F.aggregate("found", start, step, close))
    joined = inner.withColumn("_key", key).join(hits, "_key", "left")
    return joined.select(*((text if c == "text" else F.col(name)).alias(c) for c, name in own.items()))
