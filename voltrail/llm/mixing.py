"""Mixing sources to target weights with Efraimidis-Spirakis keys.

Every document draws an exponential key, -ln(u) / weight, with u from a hash of the
document, so reruns agree. Taking documents by growing key is weighted sampling
without replacement. A source's target is first filled with complete epochs of all its
documents; the rest goes to documents in key order until the token budget is met.

The order is never sorted as a whole: keys fall into order-preserving bins, bin sums
give prefix sums per source, and only the bin in which a budget ends is sorted. A
source with a third of all rows is thus one sum per task and bin, then one bin.

Defined results: a null source is a source of its own, behind all others; null or
empty texts have size 0 and come along with whole epochs (or their place in key
order); ties of keys go by doc_id, then by a hash of the text; repeated rows are rows
of their own, equal but for which of them is taken; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltrail.llm.common import SPACES, SPACE_CLASS, content, rows_again, stored, table, text_key, whole_rows

BINS = 1 << 16
#: Bits of a bin's number that its coarse bin leaves out: 256 coarse bins of 256 each.
COARSE = 8
#: Up to so many sources the table of sources is broadcast; beyond, it is joined.
SMALL_SOURCES = 50_000


def word_count(col: str = "text") -> Column:
    trimmed = F.btrim(content(col), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE_CLASS + "+"))).cast("long")


def quality_weight(col: str = "text") -> Column:
    """Between 0.1 and 1: less for texts with many digits and marks that prose lacks."""
    plain = F.char_length(F.regexp_replace(content(col), r"[0-9#$%&*|<>{}\[\]=_/\\~^@+]+", ""))
    share = plain / F.greatest(F.char_length(content(col)), F.lit(1))
    return F.lit(0.1) + F.lit(0.9) * share


def drawn(docs: DataFrame, weight: Column, seed: int) -> DataFrame:
    """doc_id, source, size, text_key, key and its bin, one row per document."""
    doc_id = F.col("doc_id").cast("long")
    h = F.xxhash64(F.lit(seed), doc_id, content())
    u = (F.shiftrightunsigned(h, 11) + F.lit(0.5)) * F.lit(2.0**-53)
    rows = docs.select(
        doc_id.alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count().alias("size"),
        text_key().alias("text_key"),
        (-F.log(u) / weight).alias("key"),
    )
    return rows.withColumn(
        "bin", F.least(F.floor(F.lit(BINS) * (1 - F.exp(-F.col("key")))), F.lit(BINS - 1)).cast("int")
    )


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Targets of `sizes` (source, source_size): shares by weight of `share` times all
    sizes, none above `most` times its source, the excess reshared by weight.

    Resharing ends where every source has min(cap, weight x level) for one level. In
    order of cap / weight the sources at their cap come first, so sums over that order
    give the level. One row per source; this is a table of sources, not of documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number + 1).cast("int"))
    everything = Window.partitionBy()
    rows = sizes.select("source", "source_size", weight.alias("w")).select(
        "*",
        (F.lit(float(most)) * F.col("source_size")).alias("cap"),
        (F.lit(float(share)) * F.sum("source_size").over(everything)).alias("all"),
        F.sum("w").over(everything).alias("all_w"),
    )
    filling = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(
        "level",
        (F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.col("all_w") - F.coalesce(F.sum("w").over(before), F.lit(0.0))),
    )
    # The level grows while sources reach their cap and falls behind the first that doesn't.
    rows = rows.withColumn("level", F.max("level").over(everything))
    target = F.least(F.col("cap"), F.col("w") * F.col("level"))
    return rows.select("source", "source_size", target.alias("target"))


def _ends(sums: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, place, rest, before: the place of `sums` (source, place, bin_size) in which
    the budget `rest` ends, `before` being the sizes of all places before it."""
    own = budgets.select(F.col("source").alias("__source"), "rest", F.col("before").alias("begun"))
    upto = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    through = F.col("begun") + F.sum("bin_size").over(upto)
    rows = sums.join(own, F.col("source").eqNullSafe(F.col("__source"))).withColumn("through", through)
    before = F.col("through") - F.col("bin_size")
    met = rows.where((F.col("through") >= F.col("rest")) & (before < F.col("rest")))
    first = F.min(F.struct("place", "rest", before.alias("before"))).alias("end")
    return met.groupBy("source").agg(first).select("source", "end.*")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    weight: Column | None = None,
    seed: int = 8,
) -> DataFrame:
    """doc_id, text_key, source, size, source_size, target, copies: how often each
    document is taken. A source's last document is taken if that ends nearer to the
    target than leaving it out."""
    rows = stored(drawn(docs, quality_weight() if weight is None else weight, seed), "mix-keys")
    bins = stored(rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size")), "mix-bins")
    sizes = bins.groupBy("source").agg(F.sum("bin_size").alias("source_size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = source_targets(sizes, weights, share, most).withColumn("epochs", epochs.cast("int"))
    targets = targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    # The bin in which a source's budget ends: first the coarse one, then the fine one in it.
    budgets = targets.select("source", "rest", F.lit(0).cast("long").alias("before"))
    coarse = bins.withColumn("place", F.shiftright("bin", COARSE))
    sums = coarse.groupBy("source", "place").agg(F.sum("bin_size").alias("bin_size"))
    wide = _ends(sums, budgets)
    inside = coarse.join(
        wide.select(F.col("source").alias("__source"), F.col("place").alias("__place")),
        F.col("source").eqNullSafe(F.col("__source")) & (F.col("place") == F.col("__place")),
        "left_semi",
    )
    narrow = _ends(
        inside.select("source", F.col("bin").alias("place"), "bin_size"), wide.select("source", "rest", "before")
    )
    ends = narrow.select(F.col("source").alias("__source"), F.col("place").alias("end_bin"), "before")
    plan = stored(
        targets.join(ends, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source"), "mix-plan"
    )
    per_source = plan.withColumnRenamed("source", "__source")
    if plan.count() <= SMALL_SOURCES:
        per_source = F.broadcast(per_source)
    dealt = rows.join(per_source, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    # Only the documents of those bins need their exact order.
    at_end = dealt.where(F.col("bin") == F.col("end_bin"))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "text_key")
    through = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    at_end = at_end.withColumn("through", through).withColumn(
        "chosen",
        (F.col("through") <= F.col("rest"))
        | (
            (F.col("through") - F.col("size") < F.col("rest"))
            & (F.col("through") - F.col("rest") < F.col("rest") - F.col("through") + F.col("size"))
        ),
    )
    clear = dealt.where(F.col("end_bin").isNull() | (F.col("bin") != F.col("end_bin"))).withColumn(
        "chosen", F.coalesce(F.col("bin") < F.col("end_bin"), F.lit(False))
    )
    kept = ("doc_id", "text_key", "source", "size", "source_size", "target")
    return clear.unionByName(at_end.drop("through")).select(
        *kept, (F.col("epochs") + F.col("chosen").cast("int")).alias("copies")
    )


def apply(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents as often as they are taken, all columns as they were."""
    key = ["doc_id", "text_key", "source"]
    a = whole_rows(docs).withColumn("source", F.col("row.source").cast("string")).alias("a")
    b = mixed.groupBy(*key).agg(F.sum("copies").alias("copies"), F.count("*").alias("alike")).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in key])
    joined = a.join(b.where("copies > 0"), same).select("a.*", "b.copies", "b.alike")
    # Rows repeated in the input share what their copies add up to.
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    more = (F.col("place") <= F.col("copies") % F.col("alike")).cast("int")
    single = joined.where("alike = 1").withColumn("n", F.col("copies"))
    several = joined.where("alike > 1").withColumn("place", place)
    several = several.withColumn("n", F.floor(F.col("copies") / F.col("alike")) + more).drop("place")
    taken = single.unionByName(several).where("n > 0")
    each = taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return rows_again(each, docs.columns)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


QUERIES = {"op8_mixing": op8_mixing}
SQL: dict[str, str] = {}
