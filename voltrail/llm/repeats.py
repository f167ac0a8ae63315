"""Removal of byte strings that start in two places, by names of growing strings.

A window is the string of `length` bytes that starts at a position. Names (hashes) stand
for the ranks of strings; names are counted by Spark, and what has a name of its own is
unique and leaves. The strings grow from step to step, until unique or past `length`:

1. Names of half a window. Inside each text, names of 1, 2, 4, ... bytes are doubled up
   to half a window, and every window picks the place with the least name in it. Equal
   windows pick the same place, so only picked places (one in about 45) go through the
   shuffle. A place whose name is unique rules out all windows that picked it.
2. Names of all windows of a place taken together (up to one and a half windows). Equal
   ones settle all these windows as repeated.
3. Where step 2 found different strings for one name of step 1: the windows of a place in
   blocks of BLOCK by their distance to it. What all windows of a block share is named;
   if unique, so are they. All of them taken together are named; if equal, they repeat.
4. Names of single windows of the blocks that step 3 leaves open.

Of equal strings only one stands in for the others in the steps behind, counting twice.
Each step is one grouping that adds up before the shuffle, and groups carry a place of
theirs out of it; nothing is joined by a name.

All positions of a full suffix array would be 16 bytes and more per byte of text and
round; picking places first makes it a sparse one. The result is exact.

Defined results: a null or empty text has no bytes; texts shorter than a window stay
whole; repeated rows are copies of each other and lose what is long enough; rows of one
doc_id with different texts are texts of their own; an empty table gives no rows. Very
long texts are scanned in parts that overlap by a window. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltrail.llm.common import content, in_batches, table, utf8

LENGTH = 200
#: Windows of a block of step 3.
BLOCK = 16
#: Bytes scanned at once: short texts together, long ones in parts.
PART = 1 << 18
_BASE = 0x85EBCA6B


def _power(n: int) -> np.uint32:
    return np.uint32(pow(_BASE, n, 1 << 32))


def doubled_names(text: np.ndarray, size: int) -> np.ndarray:
    """32-bit names of all strings of `size` bytes, by doubling."""
    power = text.astype(np.uint32) * np.uint32(0x9E3779B1) + np.uint32(12345)
    width, name, have = 1, None, 0
    while size:
        if size & 1:
            if name is None:
                name = power
            else:
                n = len(name) - width
                name = name[:n] * _power(width) + power[have : have + n]
            have += width
        size >>= 1
        if size:
            power = power[:-width] * _power(width) + power[width:]
            width *= 2
    name = (name ^ (name >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return name ^ (name >> np.uint32(12))


def _least_within(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` values in a row."""
    n, step, least = len(values) - width + 1, 1, values
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    return np.minimum(least[:n], least[width - step : width - step + n])


def _places(text: np.ndarray, length: int) -> np.ndarray:
    """The place that each window of some bytes picks."""
    half = length // 2
    names = doubled_names(text, half).astype(np.uint64) << np.uint64(32)
    names |= np.arange(len(names), dtype=np.uint64)
    return (_least_within(names, length - half + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _runs(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return begin, np.append(begin[1:], len(place)) - 1


def _picked_long(text: bytes, length: int) -> np.ndarray:
    found = []
    for start in range(0, len(text) - length + 1, PART):
        part = np.frombuffer(text, np.uint8)[start : start + PART + length - 1]
        found.append(_places(part, length) + start)
    place = np.concatenate(found)
    first, last = _runs(place)
    return np.stack([np.zeros_like(first), place[first], first, last], axis=1)


def _picked_short(texts: list[bytes], length: int) -> np.ndarray:
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    if ends[-1] < length:
        return np.zeros((0, 4), dtype=np.int64)
    place = _places(np.frombuffer(b"".join(texts), np.uint8), length)
    doc = np.repeat(np.arange(len(texts)), sizes)[: len(place)]
    inside = np.flatnonzero(np.arange(len(place)) + length <= ends[doc])
    if not len(inside):
        return np.zeros((0, 4), dtype=np.int64)
    first, last = _runs(place[inside])
    doc = doc[inside[first]]
    start = (ends - sizes)[doc]
    return np.stack([doc, place[inside[first]] - start, inside[first] - start, inside[last] - start], axis=1)


def picked_places(texts: list[bytes], length: int = LENGTH) -> np.ndarray:
    """Rows (text's number, place, first window, last window), by text and window:
    the windows first..last of the text picked this place."""
    found, some, size, begin = [], [], 0, 0

    def together() -> None:
        if some:
            rows = _picked_short(some, length)
            rows[:, 0] += begin
            found.append(rows)

    for i, text in enumerate(texts):
        if len(text) > PART:
            together()
            rows = _picked_long(text, length) if len(text) >= length else np.zeros((0, 4), dtype=np.int64)
            rows[:, 0] += i
            found.append(rows)
            some, size, begin = [], 0, i + 1
            continue
        some.append(text)
        size += len(text)
        if size >= PART:
            together()
            some, size, begin = [], 0, i + 1
    together()
    return np.concatenate(found) if found else np.zeros((0, 4), dtype=np.int64)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of all values of a column of lists."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(sizes)), sizes), values


def _among(rows: np.ndarray, at: int, column: pa.Array) -> np.ndarray:
    """Which rows have the value in their column `at` in the list of their text."""
    doc, values = _lists(column)
    if not len(values) or not len(rows):
        return np.zeros(len(rows), dtype=bool)
    width = int(max(values.max(), rows[:, at].max())) + 1
    return np.isin(rows[:, 0] * width + rows[:, at], doc * width + values)


def _blocks(rows: np.ndarray, length: int) -> np.ndarray:
    """Rows (text, first window inside, last window inside, greatest window of the whole
    block, spot, distance): the blocks of places. Spots number a text's blocks."""
    most = (length - length // 2) // BLOCK + 1
    low, high = (rows[:, 1] - rows[:, 3]) // BLOCK, (rows[:, 1] - rows[:, 2]) // BLOCK
    n = high - low + 1
    at = np.repeat(np.arange(len(rows)), n)
    j = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + low[at]
    greatest = rows[at, 1] - BLOCK * j
    first = np.maximum(rows[at, 2], greatest - BLOCK + 1)
    last = np.minimum(rows[at, 3], greatest)
    return np.stack([rows[at, 0], first, last, greatest, rows[at, 2] * (most + 1) + j, j], axis=1)


def _named(batch: pa.RecordBatch, docs: np.ndarray, columns: dict) -> dict:
    at = pa.array(docs.astype(np.int64))
    return {"id": batch.column("id").take(at), "key": batch.column("key").take(at)} | columns


def _long(names: list[int]) -> np.ndarray:
    return np.array(names, dtype=np.uint64).view(np.int64)


def half_names(docs: DataFrame, length: int) -> DataFrame:
    half = length // 2

    def rows(batch: pa.RecordBatch) -> dict:
        texts = utf8(batch.column("text"))
        found = picked_places(texts, length)
        # Places far apart may be picked by windows on both sides of better ones.
        found = np.unique(found[:, :2], axis=0)
        names = [xxhash.xxh3_64_intdigest(texts[d][p : p + half]) for d, p in found.tolist()]
        return _named(batch, found[:, 0], {"name": _long(names), "place": found[:, 1]})

    return in_batches(docs, rows, "id long, key long, name long, place int")


def whole_names(docs: DataFrame, length: int) -> DataFrame:
    """Step 2, for places whose half name recurs; a spot is the place's first window."""
    half = length // 2

    def rows(batch: pa.RecordBatch) -> dict:
        texts = utf8(batch.column("text"))
        found = picked_places(texts, length)
        found = found[~_among(found, 1, batch.column("alone"))]
        names, wholes = [], []
        for d, p, first, last in found.tolist():
            names.append(xxhash.xxh3_64_intdigest(texts[d][p : p + half]))
            wholes.append(xxhash.xxh3_64_intdigest(texts[d][first : last + length], seed=p - first))
        columns = {"name": _long(names), "whole": _long(wholes), "spot": found[:, 2]}
        return _named(batch, found[:, 0], columns | {"weight": np.ones(len(found), np.int32)})

    return in_batches(docs, rows, _STEP)


_STEP = "id long, key long, name long, whole long, spot long, weight int"


def block_names(docs: DataFrame, length: int) -> DataFrame:
    """Step 3, for the blocks of places that are open and of those that stand in."""

    def rows(batch: pa.RecordBatch) -> dict:
        texts = utf8(batch.column("text"))
        found = picked_places(texts, length)
        open_, proxy = (_among(found, 2, batch.column(c)) for c in ("open", "proxy"))
        made = [_blocks(found[chosen], length) for chosen in (open_, proxy)]
        weight = np.repeat([1, 2], [len(x) for x in made])
        ids, keys = batch.column("id").to_pylist(), batch.column("key").to_pylist()
        blocks, names, wholes = np.concatenate(made), [], []
        for d, _, _, high, spot, distance in blocks.tolist():
            # Blocks of two places may lie on the same bytes: the distance keeps them apart.
            text, low = texts[d], high - BLOCK + 1
            names.append(xxhash.xxh3_64_intdigest(text[high : max(high, low + length)], seed=distance))
            if low >= 0 and high + length <= len(text):
                wholes.append(xxhash.xxh3_64_intdigest(text[low : high + length], seed=distance))
            else:  # over the text's end: like nothing but the same row again
                wholes.append(xxhash.xxh3_64_intdigest(f"{ids[d]} {keys[d]} {spot}".encode()))
        columns = {"name": _long(names), "whole": _long(wholes), "spot": blocks[:, 4], "weight": weight}
        return _named(batch, blocks[:, 0], columns)

    return in_batches(docs, rows, _STEP)


def _singles(found: np.ndarray, batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks whose windows are named one by one, and their weights."""
    open_, proxy = (_among(found, 2, batch.column(c)) for c in ("open", "proxy"))
    of_open, of_proxy = _blocks(found[open_], length), _blocks(found[proxy], length)
    of_open_again, of_proxy = (
        np.concatenate([of_open[_among(of_open, 4, batch.column(c))], of_proxy[_among(of_proxy, 4, batch.column(c))]])
        for c in ("open_blocks", "proxy_blocks")
    )
    weights = np.repeat([1, 2], [len(of_open_again), len(of_proxy)])
    return np.concatenate([of_open_again, of_proxy]), weights


def window_names(docs: DataFrame, length: int) -> DataFrame:
    """Step 4: names of the windows of blocks that are still open, and of stand-ins."""

    def rows(batch: pa.RecordBatch) -> dict:
        texts = utf8(batch.column("text"))
        blocks, weights = _singles(picked_places(texts, length), batch, length)
        n = blocks[:, 2] - blocks[:, 1] + 1
        names = [
            xxhash.xxh3_128_digest(texts[d][s : s + length])
            for d, first, last in blocks[:, :3].tolist()
            for s in range(first, last + 1)
        ]
        pair = np.frombuffer(b"".join(names), dtype=">i8").reshape(-1, 2).astype(np.int64)
        starts = np.arange(len(names)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(blocks[:, 1], n)
        columns = {"w1": pair[:, 0], "w2": pair[:, 1], "start": starts, "weight": np.repeat(weights, n)}
        return _named(batch, np.repeat(blocks[:, 0], n), columns)

    return in_batches(docs, rows, "id long, key long, w1 long, w2 long, start int, weight int")


def removed_bytes(batch: pa.RecordBatch, length: int = LENGTH) -> list[np.ndarray]:
    """Per text, which bytes repeated windows cover."""
    texts = utf8(batch.column("text"))
    found = picked_places(texts, length)
    found = found[~_among(found, 1, batch.column("alone"))]
    is_open = _among(found, 2, batch.column("open"))
    # Windows first..last repeat, but for those that are unique by themselves.
    blocks = _blocks(found[is_open], length)
    blocks = blocks[~_among(blocks, 4, batch.column("lone_blocks"))]
    still = _among(blocks, 4, batch.column("open_blocks"))
    n = blocks[still, 2] - blocks[still, 1] + 1
    doc = np.repeat(blocks[still, 0], n)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(blocks[still, 1], n)
    windows = np.stack([doc, start, start], axis=1)
    windows = windows[~_among(windows, 1, batch.column("single"))]
    spans = np.concatenate([found[~is_open][:, [0, 2, 3]], blocks[~still][:, :3], windows])
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    edges = np.searchsorted(spans[:, 0], np.arange(len(texts) + 1))
    covered = []
    for text, low, high in zip(texts, edges[:-1], edges[1:]):
        if low == high:
            covered.append(np.zeros(len(text), dtype=bool))
            continue
        steps = np.bincount(spans[low:high, 1], minlength=len(text) + 1)
        steps -= np.bincount(spans[low:high, 2] + length, minlength=len(text) + 1)
        covered.append(np.cumsum(steps[:-1]) > 0)
    return covered


def _listed(rows: DataFrame, place: str, name: str) -> DataFrame:
    """Per document, its places; as many as its text has at most."""
    return rows.groupBy("id", "key").agg(F.collect_list(place).alias(name))


def _sorted_out(rows: DataFrame, lone: str, open_: str, proxy: str) -> DataFrame:
    """Per document, the spots whose name is unique, those whose whole is unique among
    several of one name, and those that stand in for equal wholes of such a name."""
    kinds = rows.groupBy("name", "whole").agg(
        F.sum("weight").alias("n"), F.min(F.struct("id", "key", "spot")).alias("one")
    )
    alike = Window.partitionBy("name")
    kinds = kinds.withColumns({"all": F.sum("n").over(alike), "kinds": F.count("*").over(alike)})
    left = kinds.where((F.col("all") == 1) | (F.col("kinds") > 1)).select("n", "all", "one.*")
    spot = F.col("spot")
    return left.groupBy("id", "key").agg(
        F.collect_list(F.when(F.col("all") == 1, spot)).alias(lone),
        F.collect_list(F.when((F.col("all") > 1) & (F.col("n") == 1), spot)).alias(open_),
        F.collect_list(F.when(F.col("n") > 1, spot)).alias(proxy),
    )


def found_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, text and, per document, the lists that `removed_bytes` reads.

    One plan without stops: the texts are shuffled once, by document, and all steps
    use that exchange again.
    """
    doc_id = F.col("doc_id").cast("long")
    keyed = docs.select(
        # Rows without doc_id go by their text alone, 127 bits of it, and have an odd key.
        F.coalesce(doc_id, F.xxhash64(F.lit(1), content())).alias("id"),
        F.shiftleft(F.xxhash64(content()), 1).bitwiseOR(doc_id.isNull().cast("long")).alias("key"),
        content().alias("text"),
    )
    key = ["id", "key"]
    places = half_names(keyed.where(F.octet_length("text") >= length), length)
    alone = (
        places.groupBy("name")
        .agg(F.count("*").alias("n"), *[F.min(c).alias(c) for c in ("id", "key", "place")])
        .where("n = 1")
    )
    texts = keyed.join(_listed(alone, "place", "alone"), key, "left")
    texts = texts.join(_sorted_out(whole_names(texts, length), "none", "open", "proxy").drop("none"), key, "left")
    blocks = block_names(texts.select(*key, "text", "open", "proxy"), length)
    blocks = _sorted_out(blocks, "lone_blocks", "open_blocks", "proxy_blocks")
    texts = texts.join(blocks, key, "left")
    wanted = texts.select(*key, "text", "open", "proxy", "open_blocks", "proxy_blocks")
    single = (
        window_names(wanted, length)
        .groupBy("w1", "w2")
        .agg(F.sum("weight").alias("n"), *[F.min(c).alias(c) for c in ("id", "key", "start")])
        .where("n = 1")
    )
    texts = texts.join(_listed(single, "start", "single"), key, "left")
    lists = ("alone", "open", "lone_blocks", "open_blocks", "single")
    return texts.select(F.when(F.col("key").bitwiseAND(1) == 0, F.col("id")).alias("doc_id"), "text", *lists)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = found_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def rows(batch: pa.RecordBatch) -> dict:
        made = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        for text, gone in zip(utf8(batch.column("text")), removed_bytes(batch)):
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            made["n_bytes"].append(len(text))
            made["n_removed"].append(len(text) - len(kept))
            made["n_spans"].append(int(gone[:1].sum() + np.count_nonzero(gone[1:] & ~gone[:-1])))
            made["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        return {"doc_id": batch.column("doc_id")} | made

    return in_batches(
        found, rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


QUERIES = {"op5_suffix_dedup": op5_suffix_dedup}
SQL: dict[str, str] = {}
