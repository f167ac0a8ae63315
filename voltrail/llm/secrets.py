"""Secret scans with multipart linking, DataFrame only.

Base kinds are reported wherever they match. Weak kinds (user names and client ids,
mixed-case tokens, service addresses) say little alone; they are reported only where
complementary parts stand in the same scope: an identifier with a secret, a secret
with an identifier, an endpoint with both. A scope reaches SCOPE code points either
way, from the end of one span to the start of the next, however long the spans are.
Base spans count as parts too.

Spans come from splitting a text by the pattern: the pieces and the matches between
them add up to positions. Parts are joined over intervals by cells of SCOPE code
points, a span standing in all cells from its start to its end: of each cell only the
least start and the greatest end per part is kept. In the cells of a span itself and
between them all is in scope, and in the cell before and behind these two tell it, so a
text full of candidates makes no pairs.

Defined results: a null or empty text has no spans (and the digest of nothing);
repeated rows get the same result each; rows of one doc_id with different texts are
scanned each for itself; a null doc_id stays null; an empty table gives no rows.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltrail.llm.common import content, stored, table

SCOPE = 256

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def _any(m: Column) -> Column:
    return F.lit(True)


def _mixed(m: Column) -> Column:
    return m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]")


#: kind, part it plays, whether it is base, pattern, and what a match must fulfil.
KINDS: list[tuple[str, str, bool, str, Callable[[Column], Column]]] = [
    ("assign", "secret", True, _ASSIGN, lambda m: F.char_length(F.regexp_extract(m, _ASSIGN, 1)) >= 8),
    ("access", "identifier", True, "AKIA[A-Z0-9]+", lambda m: F.char_length(m) >= 16),
    # Runs of fewer than 32 fail anyway and no other match can start inside one.
    ("hex", "secret", True, "[0-9a-f]{32,}", _any),
    (
        "identifier",
        "identifier",
        False,
        r"""\b(?:(?:ASIA|AIDA|AROA)[A-Z0-9]{12,}|(?i:client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,})""",
        _any,
    ),
    ("candidate", "secret", False, "[A-Za-z0-9+/_-]{20,}={0,2}", _mixed),
    (
        "endpoint",
        "endpoint",
        False,
        r"""\b(?:(?i:https?|s3|jdbc:[a-z]{2,12}|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\s"'<>]+|(?i:host|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,})""",
        _any,
    ),
]
_ORDER = {kind: i for i, (kind, *_) in enumerate(KINDS)}
_NEEDS = {"identifier": ("secret",), "secret": ("identifier",), "endpoint": ("identifier", "secret")}


def _kind(table: dict[str, object], name: str) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[F.col(name)]


def matches(docs: DataFrame) -> DataFrame:
    """kind, start, end (code points, end exclusive) of all matches, weak ones too, with
    the document's key (id, text_key) and the number of its row."""
    text = F.col("text")
    rows = docs.select("id", "text_key", "text", F.monotonically_increasing_id().alias("row"))
    rows = rows.where(reduce(lambda a, b: a | b, [text.rlike(k[3]) for k in KINDS]))

    def found(kind: str, pattern: str) -> Column:
        none = F.array().cast("array<struct<kind:string,at:int,gap:int,m:string>>")
        parts = F.arrays_zip(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
            F.split(text, pattern, -1).alias("gap"),
        )
        made = F.transform(
            parts,
            lambda x, i: F.struct(
                F.lit(kind).alias("kind"), i.alias("at"), F.char_length(x["gap"]).alias("gap"), x["m"].alias("m")
            ),
        )
        return F.when(text.rlike(pattern), made).otherwise(none)

    each = rows.select(
        "id",
        "text_key",
        "row",
        F.explode(F.concat(*[found(kind, pattern) for kind, _, _, pattern, _ in KINDS])).alias("x"),
    ).select("id", "text_key", "row", "x.*")
    fulfils = reduce(
        lambda rest, k: F.when(F.col("kind") == k[0], k[4](F.col("m"))).otherwise(rest), KINDS, F.lit(False)
    )
    each = stored(
        each.where(F.col("m").isNotNull()).select(
            "id", "text_key", "row", "kind", "at", "gap", F.char_length("m").alias("n"), fulfils.alias("ok")
        ),
        "secret-matches",
    )
    upto = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap").cast("long") + F.col("n")).over(upto)
    spans = each.withColumn("end", end).where("ok")
    spans = spans.select("id", "text_key", "row", "kind", (F.col("end") - F.col("n")).alias("start"), "end")
    # Repeated rows have the same spans.
    first = Window.partitionBy("id", "text_key")
    return spans.withColumn("first", F.min("row").over(first)).where("row = first").drop("row", "first")


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Base spans, and those weak ones whose complementary parts are in scope."""
    base = {kind: is_base for kind, _, is_base, _, _ in KINDS}
    parts = {kind: part for kind, part, *_ in KINDS}
    first, last = F.floor(F.col("start") / scope), F.floor(F.col("end") / scope)
    own = spans.withColumns({"base": _kind(base, "kind"), "part": _kind(parts, "kind")})
    # A weak span inside a base span is the same thing again.
    sofar = Window.partitionBy("id", "text_key").orderBy("start", F.col("base").desc()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    own = own.withColumn("covered", F.max(F.when(F.col("base"), F.col("end"))).over(sofar))
    own = stored(
        own.where(F.col("base") | F.col("covered").isNull() | (F.col("start") >= F.col("covered"))).drop("covered"),
        "secret-parts",
    )
    spread = own.withColumn("near", F.explode(F.sequence(first, last)))
    cells = spread.groupBy("id", "text_key", "near", F.col("part").alias("with")).agg(
        F.min("start").alias("low"), F.max("end").alias("high")
    )
    weak = own.where(~F.col("base"))
    asked = weak.withColumn("near", F.explode(F.sequence(first - 1, last + 1)))
    reach = (F.col("low") <= F.col("end") + scope) & (F.col("high") >= F.col("start") - scope)
    met = (
        asked.join(cells, ["id", "text_key", "near"])
        .where(reach & (F.col("with") != F.col("part")))
        .groupBy("id", "text_key", "kind", "part", "start", "end")
        .agg(F.collect_set("with").alias("met"))
    )
    needs = reduce(
        lambda rest, x: F.when(
            F.col("part") == x[0], reduce(lambda a, b: a & b, [F.array_contains("met", p) for p in x[1]])
        ).otherwise(rest),
        _NEEDS.items(),
        F.lit(False),
    )
    columns = ["id", "text_key", "kind", "start", "end"]
    return own.where("base").select(*columns).unionByName(met.where(needs).select(*columns))


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, and its spans as sorted arrays of
    (start, place of the kind, kind, end): `base` and `found` (all)."""
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(doc_id, F.lit(0)).alias("id"),
        F.xxhash64(doc_id.isNull(), content()).alias("text_key"),
        content().alias("text"),
    )
    one = F.struct("start", _kind(_ORDER, "kind").alias("place"), "kind", "end")
    per_text = (
        linked(matches(rows), scope)
        .groupBy("id", "text_key")
        .agg(F.sort_array(F.collect_list(one)).alias("found"))
    )
    joined = rows.drop("text").join(per_text, ["id", "text_key"], "left")
    none = F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")
    joined = joined.withColumn("found", F.coalesce("found", none))
    joined = joined.withColumn("base", F.filter("found", lambda s: s["place"] < 3))

    def counted(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return joined.select("doc_id", *[counted(k) for k in ("assign", "access", "hex")], "base", "found")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(F.encode(_listed(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
    )


QUERIES = {"op10_secret_scan": op10_secret_scan}
SQL: dict[str, str] = {}
