"""Approximate nearest neighbours: an adaptive dimension scan in inverted lists.

Vectors belong to the list of their nearest centre. A query probes its nearest list
first; the k-th best distance found there goes with it to the other lists it probes.
Within each, distances are added up over blocks of dimensions of the randomly rotated
vectors. After each block a test asks whether the part seen so far can still belong to
one of the k nearest: for a random rotation the partial square scaled up to all
dimensions exceeds (1 + slack / sqrt(seen))^2 times the true one only rarely, so
candidates beyond the best k-th distance so far by more than that are abandoned; that
distance falls while a list is read. The few that stay among the k nearest are measured
exactly, in double precision on the original vectors.

The rotation, the centres, the slack and the number of lists to probe are fitted on at
most SAMPLE vectors, picked by a hash of theirs: the slack with which the tests pass KEPT
of the sample's true neighbours, and the least number of lists that holds TARGET of them. Every vector is indexed. Lists are cut into packs of about
PACK vectors, so a list of any size, or a vector repeated without end, is spread over
tasks; each pack gives its k best per query and the best of those are kept.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, rows without vec_id, and vectors of another length than the most common one
(of equally common ones the longer) take no part; rows equal in vec_id and vector count
once; ties go to the smaller vec_id; a query with fewer than k candidates gets them
all; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltrail.llm.common import in_batches, stored, table

SAMPLE = 8_192
MAX_LISTS = 1_024
PER_LIST = 1_024
PACK = 2_048
TARGET = 0.98
KEPT = 0.95
BLOCK = 16
#: Where the sample has no neighbours to fit it on.
SLACK = 2.1
K = 10


@dataclass
class Index:
    rotation: np.ndarray
    centres: np.ndarray
    probes: int
    slack: float = SLACK


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array<double>) of the rows that take part."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).where("vec_id is not null and vector is not null")
    rows = rows.where(F.forall("vector", finite)).where(F.exists("vector", lambda x: x != 0))
    rows = rows.distinct()
    # One row per length of vectors.
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("vector") == (common["d"] if common else 0))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None], 0)


def fit(rows: DataFrame, k: int = K, sample: int = SAMPLE, target: float = TARGET) -> Index:
    n = rows.count()
    # About `sample` rows by their hash, and never more than that.
    share = min(1.0, 0.9 * sample / n) if n > sample else 1.0
    place = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 30))
    some = rows.where(place < int(share * (1 << 30))).limit(sample).collect()
    some.sort(key=lambda r: r["vec_id"])
    x = np.array([r["vector"] for r in some], dtype=float)
    if not len(x):
        return Index(np.zeros((0, 0)), np.zeros((0, 0)), 0)
    rng = np.random.default_rng(4)
    rotation = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))[0]
    lists = int(np.clip(n // PER_LIST, 1, min(MAX_LISTS, len(x))))
    centres = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(12):
        own = _squares(x, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        counts = np.bincount(own, minlength=lists)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    own = _squares(x, centres).argmin(1)
    asked = x[rng.choice(len(x), min(256, len(x)), replace=False)]
    # Where among a query's lists, from the nearest, its true neighbours lie.
    place = np.argsort(np.argsort(_squares(asked, centres), axis=1), axis=1)
    near = np.argsort(_squares(asked, x), axis=1)[:, 1 : k + 1]
    depth = np.sort(np.take_along_axis(place, own[near], axis=1).ravel())
    probes = int(depth[int(np.ceil(target * len(depth))) - 1]) + 1 if len(depth) else lists
    return Index(rotation, centres, probes, _fitted_slack(asked @ rotation, x @ rotation, near))


def _fitted_slack(asked: np.ndarray, x: np.ndarray, near: np.ndarray) -> float:
    """The slack with which KEPT of the neighbours pass every test, if the bound is the
    true distance of the last of them."""
    if not near.size:
        return SLACK
    gaps = np.cumsum((x[near] - asked[:, None]) ** 2, axis=2)
    last = np.sqrt(gaps[:, -1, -1])
    gaps, last = gaps[last > 0], last[last > 0]
    seen = np.arange(BLOCK, x.shape[1], BLOCK)
    if not len(last) or not len(seen):
        return SLACK
    scaled = np.sqrt(gaps[:, :, seen - 1] * (x.shape[1] / seen)) / last[:, None, None]
    return max(0.0, float(np.quantile(((scaled - 1) * np.sqrt(seen)).max(axis=2), KEPT)))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def with_lists(rows: DataFrame, index: Index) -> DataFrame:
    def assigned(batch: pa.RecordBatch) -> dict:
        near = _squares(_matrix(batch.column("vector")), index.centres).argmin(1)
        return {"vec_id": batch.column("vec_id"), "vector": batch.column("vector"), "list": near}

    return in_batches(rows, assigned, "vec_id long, vector array<double>, list int")


def packed(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """One row per group of `by`: ids, vectors and (if there) bounds as bytes."""
    bounded = "bound" in rows.columns

    def pack(group: pa.Table) -> pa.Table:
        ids = group.column("vec_id").combine_chunks().to_numpy()
        matrix = _matrix(group.column("vector").combine_chunks())
        made = {
            "list": group.column("list").slice(0, 1),
            f"{name}_ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
            f"{name}_vectors": pa.array([matrix.astype("<f8").tobytes()], pa.binary()),
        }
        if bounded:
            bounds = group.column("bound").combine_chunks().to_numpy()
            made["bounds"] = pa.array([bounds.astype("<f8").tobytes()], pa.binary())
        return pa.table(made)

    schema = f"list int, {name}_ids binary, {name}_vectors binary" + ", bounds binary" * bounded
    return rows.groupBy(*by).applyInArrow(pack, schema)


class Reader:
    """The adaptive scan of packs; `read` counts the dimensions it has looked at."""

    def __init__(self, index: Index, k: int):
        self.rotation, self.slack, self.k = index.rotation, index.slack, k
        self.read = 0

    def scan(
        self, query: np.ndarray, turned: np.ndarray, pack: np.ndarray, turned_pack: np.ndarray, skip: np.ndarray,
        bound: float = np.inf,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of a pack's k nearest (with ties) below the distance `bound`."""
        k, d = self.k, pack.shape[1]
        rest = np.flatnonzero(~skip)
        # Turning loses some digits: what equals the bound must pass.
        spare = 1e-9 * (1.0 + float(turned @ turned))
        square = bound * bound
        places, squares = [np.zeros(0, dtype=np.int64)], [np.zeros(0)]
        size = max(8 * k, 64)
        while len(rest):
            some, rest = rest[:size], rest[size:]
            part = np.zeros(len(some))
            for start in range(0, d, BLOCK):
                seen = min(start + BLOCK, d)
                self.read += len(some) * (seen - start)
                part += ((turned_pack[some, start:seen] - turned[start:seen]) ** 2).sum(1)
                if np.isfinite(square):
                    limit = square * (seen / d) * (1 + self.slack / np.sqrt(seen)) ** 2 if seen < d else square
                    stay = part <= limit + spare
                    some, part = some[stay], part[stay]
            places.append(some)
            squares.append(part)
            if sum(map(len, squares)) >= k:
                square = min(square, float(np.partition(np.concatenate(squares), k - 1)[k - 1]))
            size *= 4
        at, part = np.concatenate(places), np.concatenate(squares)
        at = at[part <= square + spare]
        self.read += len(at) * d
        exact = np.sqrt(((pack[at] - query) ** 2).sum(1))
        if len(at) > k:
            keep = exact <= np.partition(exact, k - 1)[k - 1]
            at, exact = at[keep], exact[keep]
        return at, exact

    def batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k nearest of each pack for each query of the row beside it."""
        for batch in batches:
            for ids, flat, query_ids, query_flat, bounds in zip(*(c.to_pylist() for c in batch.columns)):
                ids, query_ids = np.frombuffer(ids, "<i8"), np.frombuffer(query_ids, "<i8")
                pack = np.frombuffer(flat, "<f8").reshape(len(ids), -1)
                queries = np.frombuffer(query_flat, "<f8").reshape(len(query_ids), -1)
                bounds = np.frombuffer(bounds, "<f8")
                turned_pack, turned = pack @ self.rotation, queries @ self.rotation
                made = []
                for i, query_id in enumerate(query_ids):
                    at, score = self.scan(queries[i], turned[i], pack, turned_pack, ids == query_id, bounds[i])
                    order = np.lexsort((ids[at], score))[: self.k]
                    made.append((np.full(len(order), query_id), ids[at][order], score[order]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in zip(*made)], names=["query_id", "vec_id", "score"]
                )


def nearest(vectors: DataFrame, is_query: Column, k: int = K, index: Index | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for each query row."""
    rows = stored(usable(vectors), "vectors")
    index = fit(rows, k) if index is None else index
    schema = "query_id long, vec_id long, score double"
    if not len(index.centres):
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    listed = stored(with_lists(rows, index), "vector-lists")
    # One row per list, at most MAX_LISTS.
    sizes = np.zeros(len(index.centres), dtype=np.int64)
    for row in listed.groupBy("list").count().collect():
        sizes[row["list"]] = row["count"]
    of_list = F.element_at(F.array(*[F.lit(int(-(-s // PACK) or 1)) for s in sizes]), F.col("list") + 1)
    packs = packed(
        listed.withColumn("part", F.pmod(F.xxhash64("vec_id", "vector"), of_list)), ["list", "part"], "pack"
    )

    def probed(batch: pa.RecordBatch) -> dict:
        order = np.argsort(_squares(_matrix(batch.column("vector")), index.centres), axis=1, kind="stable")
        reach = np.cumsum(sizes[order], axis=1)
        # The fitted number of lists, and on until they hold k candidates besides the query.
        need = np.maximum(index.probes, (reach < min(sizes.sum(), 4 * k + 1)).sum(1) + 1)
        wanted = np.arange(order.shape[1])[None] < need[:, None]
        at, turn = np.nonzero(wanted)
        return {
            "vec_id": batch.column("vec_id").take(pa.array(at)),
            "vector": batch.column("vector").take(pa.array(at)),
            "list": order[wanted],
            "turn": turn,
        }

    asked = in_batches(
        listed.where(is_query).select("vec_id", "vector"), probed, "vec_id long, vector array<double>, list int, turn int"
    )
    asked = stored(asked, "asked-lists")

    def found_by(queries: DataFrame) -> DataFrame:
        dealt = queries.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(_query_parts(sizes.sum()))))
        own = packed(dealt, ["list", "part"], "query")
        pairs = packs.join(own.withColumnRenamed("list", "asked"), F.col("list") == F.col("asked")).select(
            "pack_ids", "pack_vectors", "query_ids", "query_vectors", "bounds"
        )
        return pairs.mapInArrow(Reader(index, k).batches, schema)

    order = Window.partitionBy("query_id").orderBy("score", "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    unbounded = F.lit(float("inf"))
    first = stored(ranked(found_by(asked.where("turn = 0").withColumn("bound", unbounded))), "nearest-lists")
    bounds = first.where(F.col("rank") == k).select(F.col("query_id").alias("of"), F.col("score").alias("best"))
    others = (
        asked.where("turn > 0")
        .join(bounds, F.col("vec_id") == F.col("of"), "left")
        .withColumn("bound", F.coalesce("best", unbounded))
        .drop("of", "best")
    )
    return ranked(first.drop("rank").unionByName(found_by(others))).select("query_id", "rank", "vec_id", "score")


def _query_parts(n: int) -> int:
    """Packs the queries of a list are dealt to, about 512 where a hundredth asks."""
    return max(1, int(n) // 51_200)


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES = {"op4_nearest_neighbours": op4_nearest_neighbours}
SQL: dict[str, str] = {}
