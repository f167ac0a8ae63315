"""SimHash near-dedup: a segment-popcount embedding and a grid range join.

Every fingerprint is cut into segments of two bits. The bits set per segment are its
point in the embedding, written in unary (0: 00, 1: 01, 2: 11), so that the Manhattan
distance of two points is the number of bits in which their codes differ; it never
exceeds the Hamming distance of the fingerprints. Points within `max_bits` agree in all
but `max_bits` of `max_bits + 3` groups of segments, so the grid has one cell per choice
of three groups and value there. Points of a cell are joined, filtered by Manhattan
distance and then by the exact Hamming distance.

Exact copies are one point, however many. A cell with more than CROWDED different
points would make too many pairs; its points are linked over midpoints instead: two
points are within 3 bits just if some word is within 1 bit of one and 2 bits of the
other, so all points at a word that has one within 1 bit hang on that one. This finds
the same components with a fixed number of rows per point.

Defined results: null, empty and wordless texts have fingerprint zero and link like
any other; repeated rows are rows of one fingerprint; a null doc_id never is a
component's id unless the component has no other; components that share an id, or have
none, stay apart when one document of each is kept; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltrail.llm.common import content, in_batches, rows_again, stored, table, text_key, utf8, whole_rows
from voltrail.llm.components import components

SEED = 42
CROWDED = 4096
_PART = 1 << 16
_EVEN = 0x5555555555555555


def fingerprint(text: bytes, words: int = 3) -> int:
    """Signed 64-bit SimHash of the shingles; zero without words."""
    found = text.lower().split()
    if not found:
        return 0
    votes, n = np.zeros(64, dtype=np.int64), max(1, len(found) - words + 1)
    for start in range(0, n, _PART):  # very long texts in parts
        part = found[start : min(start + _PART, n) + words - 1]
        shingles = [part[i : len(part) - words + 1 + i] for i in range(words)] if len(part) >= words else [[x] for x in part]
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*shingles))),
            dtype=np.uint64,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, text_key, fp of every row."""

    def rows(batch: pa.RecordBatch) -> dict:
        return {
            "doc_id": batch.column("doc_id"),
            "text_key": batch.column("text_key"),
            "fp": [fingerprint(t, words) for t in utf8(batch.column("text"))],
        }

    picked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), content().alias("text"), text_key().alias("text_key")
    )
    return in_batches(picked, rows, "doc_id long, text_key long, fp long")


def _signed(word: int) -> int:
    return word - (1 << 64) if word >= 1 << 63 else word


def embedded(fp: Column) -> Column:
    """Unary code of the bits set in each two-bit segment."""
    even = F.lit(_EVEN)
    high = F.shiftrightunsigned(fp, 1)
    # 01 if any bit is set, 11 if both are.
    some = (fp.bitwiseOR(high)).bitwiseAND(even)
    both = (fp.bitwiseAND(high)).bitwiseAND(even)
    return some.bitwiseOR(F.shiftleft(both, 1))


def cell_masks(max_bits: int, kept: int = 3) -> list[int]:
    """Masks of the codes of `kept` of `max_bits + kept` groups of segments."""
    groups = [sum(3 << (2 * int(i)) for i in g) for g in np.array_split(np.arange(32), max_bits + kept)]
    return [_signed(sum(c)) for c in combinations(groups, kept)]


def near_links(points: DataFrame, max_bits: int = 3, crowded: int = CROWDED) -> DataFrame:
    """a, b: fingerprints (column fp, distinct) whose links give the components of all
    pairs within `max_bits` bits. Cells with up to `crowded` points link all their
    pairs, others link over midpoints (for `max_bits` 3)."""
    masks = cell_masks(max_bits)
    code = embedded(F.col("fp"))
    cells = points.select(
        "fp",
        code.alias("code"),
        F.posexplode(F.array(*[code.bitwiseAND(F.lit(m)) for m in masks])).alias("grid", "cell"),
    )
    full = stored(cells.groupBy("grid", "cell").count().where(F.col("count") > crowded), "crowded-cells")
    if full.isEmpty():
        roomy, dense = cells, None
    else:
        roomy = cells.join(full, ["grid", "cell"], "left_anti")
        dense = cells.join(full, ["grid", "cell"], "left_semi").select("fp").distinct()
    a, b = roomy.alias("a"), roomy.alias("b")
    near = (
        (F.col("a.grid") == F.col("b.grid"))
        & (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (F.bit_count(F.col("a.code").bitwiseXOR(F.col("b.code"))) <= max_bits)
        & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits)
    )
    links = a.join(b, near).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    if dense is not None:
        links = links.unionByName(midpoint_links(dense, max_bits))
    return links.distinct()


def midpoint_links(points: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links between points within 3 bits, and only such as share a component."""
    if max_bits != 3:
        raise ValueError("midpoints are laid out for 3 bits")
    one = [1 << i for i in range(64)]
    flips = [(0, 0), *((1, x) for x in one), *((2, x | y) for x, y in combinations(one, 2))]
    table_of = F.array(
        *[F.struct(F.lit(d).alias("d"), F.lit(_signed(x)).alias("x")) for d, x in flips]
    )
    at = points.withColumn("flip", F.explode(table_of)).select(
        "fp", F.col("flip.d").alias("d"), F.col("fp").bitwiseXOR(F.col("flip.x")).alias("mid")
    )
    hubs = at.where("d <= 1").groupBy("mid").agg(F.min("fp").alias("hub"))
    return at.join(hubs, "mid").where("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b"))


def near_groups(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """`prints` (doc_id, text_key, fp), component (its smallest fingerprint, which tells
    components apart whatever their ids) and component_id, the smallest doc_id reachable."""
    points = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fingerprint-points")
    parts = components(near_links(points.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    linked = points.join(parts, "fp")
    least = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = linked.join(least, "root").select("fp", "root", "component_id")
    own = points.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("root", "fp").alias("component"),
        F.coalesce("component_id", "least_id").alias("component_id"),
    )
    return prints.join(own, "fp")


def grouped(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    return near_groups(stored(fingerprints(docs, words), "fingerprints"), max_bits)


def apply(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One document of each group: that with the smallest doc_id (then the smallest
    text_key); of rows repeated with both equal, one."""
    best = groups.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("best")
    )
    a, b = whole_rows(docs).alias("a"), best.select("best.*").alias("b")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_key") == F.col("b.text_key"))
    alike = Window.partitionBy("doc_id", "text_key").orderBy(F.lit(0))
    kept = a.join(b, same).select("a.*").withColumn("n", F.row_number().over(alike)).where("n = 1")
    return rows_again(kept, docs.columns)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = grouped(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


QUERIES = {"op2_simhash_near_dedup": op2_simhash_near_dedup}
SQL: dict[str, str] = {}
