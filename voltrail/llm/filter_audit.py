"""Filter interaction audit: what every order of some filters removes, in one pass.

A document's outcomes depend only on which filters it fails, its mask. Every mask is
mapped once to a wide integer of packed counters: for each order and step, one field
each for "removed here", "redundant here" and "fails this filter only", FIELD bits wide.
Rows are counted per part, mask and labels first (combined before the shuffle), so a
part has a bounded number of cells however many rows it has; the integer of the mask times
that count is summed per part, one sum over all rows, one over good and one over toxic
ones. A field can hold any count that fits a long, so no field runs into the next, and
the sums are unpacked field by field.

Whether a text is identical to that of a smaller doc_id is told from SHA-256 digests: the
smallest doc_id per digest, from rows that are combined by digest, part and labels first.

Defined results: a null text is empty, a null source the part ''; rows without doc_id
have no smaller one, are no smaller one for others and have no labels; rows that share a
doc_id and a text are no copies of each other; of several labels of one doc_id the
greatest count; null labels are 0. Very long texts are one row like any other. Only the
columns named here are read, so others may have any name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail.llm.common import SPACE_CLASS, content, stored, table

#: Filters by letter; a document's mask has one bit for each, the first one lowest.
FILTERS = "ABCDE"
#: Bits of a packed counter; counts are longs.
FIELD = 64
#: Parts unpacked into one batch of rows.
_PARTS = 64
_OUT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def _mask(fails: list[Column]) -> Column:
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(fails)]
    return reduce(lambda a, b: a + b, bits)


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good, toxic and the number `n` of documents, with the contract's filters."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        content().alias("text"),
    )
    words = F.filter(F.split("text", SPACE_CLASS + "+"), lambda w: w != "")
    counted = texts.withColumn("words", words).select(
        "doc_id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.char_length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")).cast("long").alias("n_others"),
        F.col("text").rlike("[#$%&*|]").alias("symbols"),
    )
    own = [
        F.col("n_words") < 200,
        100 * F.col("n_distinct") < 50 * F.col("n_words"),
        100 * (F.col("n_chars") - F.col("n_others")) > 2 * F.col("n_chars"),
        F.col("symbols"),
    ]
    # Read by the search for first copies and by the join with it.
    narrow = stored(counted.select("doc_id", "part", "digest", _mask(own).alias("mask")), "audit-masks")
    flags = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    # Rows are combined by document, then by text, part and labels, before texts are
    # compared: a text that a third of all rows hold is a few cells by then.
    cell = ("digest", "part", "mask", "good", "toxic")
    cells = (
        narrow.where("doc_id IS NOT NULL")
        .join(flags, "doc_id", "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
        .groupBy("doc_id", *cell)
        .agg(F.count("*").alias("n"))
        .groupBy(*cell)
        .agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("lowest"))
    )
    first = cells.groupBy("digest").agg(F.min("lowest.doc_id").alias("first_id"))
    holds_first = F.col("lowest.doc_id") == F.col("first_id")
    firsts = F.when(holds_first, F.col("lowest.n")).otherwise(0)
    split = F.array(
        F.struct(F.col("mask").alias("mask"), firsts.alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - firsts).alias("n")),
    )
    told = cells.join(first, "digest").select("part", "good", "toxic", F.inline(split)).where("n > 0")
    nameless = (
        narrow.where("doc_id IS NULL").groupBy("part", "mask").agg(F.count("*").alias("n"))
    ).withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    return told.unionByName(nameless)


def orders(filters: str = FILTERS) -> list[str]:
    return ["".join(p) for p in permutations(filters)]


@cache
def wide(mask: int, filters: str = FILTERS) -> int:
    """The packed step outcomes of a document with this mask.

    Field 3 * (steps * order + step) counts removals, the next one redundancies, the one
    after it the documents that fail only the step's filter.
    """
    bit = {f: 1 << i for i, f in enumerate(filters)}
    packed = place = 0
    for order in orders(filters):
        gone = False
        for f in order:
            if mask & bit[f]:
                packed |= 1 << (place + (FIELD if gone else 0))
                if mask == bit[f]:
                    packed |= 1 << (place + 2 * FIELD)
                gone = True
            place += 3 * FIELD
    return packed


def unpacked(packed: int, filters: str = FILTERS) -> np.ndarray:
    """Counters by order, step and kind."""
    n = len(filters)
    fields = len(orders(filters)) * n * 3
    raw = packed.to_bytes(fields * FIELD // 8, "little")
    return np.frombuffer(raw, dtype="<i8").reshape(-1, n, 3)


def _part_rows(cells: list[dict], filters: str) -> list[np.ndarray]:
    """The counts of one part, by order and step, in the order of the output columns."""
    total, every, good, toxic = 0, 0, 0, 0
    for cell in cells:
        n = cell["n"]
        weighed = n * wide(cell["mask"], filters)
        total += n
        every += weighed
        good += weighed if cell["good"] else 0
        toxic += weighed if cell["toxic"] else 0
    counts = unpacked(every, filters)
    removed = counts[:, :, 0]
    by_filter = {
        f: sum(int(removed[i, o.index(f)]) for i, o in enumerate(orders(filters))) for f in filters
    }
    shapley = np.array([[by_filter[f] for f in o] for o in orders(filters)])
    return [
        total - np.cumsum(removed, axis=1),
        removed,
        counts[:, :, 1],
        counts[:, :, 2],
        unpacked(good, filters)[:, :, 0],
        unpacked(toxic, filters)[:, :, 0],
        shapley,
    ]


def interactions(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step; `masks` has part, mask,
    good, toxic and the number n of documents."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(_OUT))
    cells = masks.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    # At most one cell per mask and label pair.
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = orders(filters)
        n_rows = len(names) * len(filters)
        order_of = np.repeat(np.array(names, dtype=object), len(filters))
        step_of = np.tile(np.arange(1, len(filters) + 1, dtype=np.int32), len(names))
        for batch in batches:
            for at in range(0, batch.num_rows, _PARTS):
                some = batch.slice(at, _PARTS)
                counts = [_part_rows(c, filters) for c in some.column("cells").to_pylist()]
                columns = [
                    pa.array(np.repeat(np.array(some.column("part").to_pylist(), dtype=object), n_rows), pa.string()),
                    pa.array(np.tile(order_of, len(counts)), pa.string()),
                    pa.array(np.tile(step_of, len(counts))),
                    *[pa.array(np.concatenate([c[i].ravel() for c in counts])) for i in range(7)],
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return parts.mapInArrow(run, _OUT)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(failure_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


QUERIES = {"op12_filter_audit": op12_filter_audit}

SQL = {
    "op12_filter_audit": r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
    FROM documents
), flags AS (
    SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic
    FROM labels GROUP BY doc_id
), failing AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN texts.doc_id > first_id THEN 'E' ELSE '' END AS failed
    FROM texts LEFT JOIN flags USING (doc_id)
), cells AS (
    SELECT part, good, toxic, failed, count(*) AS n FROM failing GROUP BY ALL
), orders AS (
    SELECT '' AS filter_order
    UNION ALL
    SELECT filter_order || f FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f)
    WHERE NOT contains(filter_order, f)
), steps AS (
    SELECT filter_order, unnest(range(1, 6))::INT AS step FROM orders WHERE length(filter_order) = 5
), outcomes AS (
    SELECT part, good, toxic, failed, n, filter_order, step, filter_order[step] AS f,
           contains(failed, filter_order[step]) AS fails,
           coalesce(list_min([strpos(filter_order, x) FOR x IN string_split(failed, '') IF x <> '']), 9) AS first_step
    FROM cells, steps
), counted AS (
    SELECT part, filter_order, step, f,
           coalesce(sum(n) FILTER (first_step > step), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (first_step = step), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (fails AND first_step < step), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (failed = f), 0)::BIGINT AS unique_fails,
           coalesce(sum(n) FILTER (first_step = step AND good = 1), 0)::BIGINT AS good_lost,
           coalesce(sum(n) FILTER (first_step = step AND toxic = 1), 0)::BIGINT AS toxic_lost
    FROM outcomes GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted"""
}
