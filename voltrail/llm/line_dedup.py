"""Line dedup: lines that many documents share are dropped.

Hashes of line keys go through a range partitioning by (hash, document) and a sort
within partitions by (hash, document, position). A partition is then read as a
stream of runs of one hash. Only the first documents of a run are held back until it
is known whether the run reaches `min_docs`; after that its rows pass straight
through, so memory does not depend on how common a line is. A very common line spans
several partitions; of the runs at a partition's two ends the stream reports how many
documents it has seen, and those few reports decide about what was held back there.

What comes out is one compressed bitmap per document (bit set: line stays), not text.

Defined results: a null or empty text is one empty line; keys shorter than
`min_chars` code points (so empty lines) never drop; rows that share a doc_id (null
included) count as one document, each keeps a bitmap of its own text, repeated rows
get the same one; extra columns pass through `apply`. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail.llm.common import (
    SPACES,
    content,
    in_batches,
    rows_again,
    stored,
    table,
    text_key,
    utf8,
    whole_rows,
)

_STRIP = SPACES.encode()
_DROP, _PENDING, _COUNT = 0, 1, 2
_LINES = "h1 long, h2 long, doc_id long, text_key long, pos int"
_VERDICTS = (
    "kind int, h1 long, h2 long, doc_id long, text_key long, pos int, head boolean, n int, part int"
)


def line_key(line: bytes) -> bytes:
    """White space off both ends, A-Z lower-cased (bytes.lower knows only ASCII)."""
    return line.strip(_STRIP).lower()


def line_rows(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """One row per line whose key is long enough: 128-bit hash, document, position."""

    def rows(batch: pa.RecordBatch) -> dict:
        hashes, counts, positions = [], [], []
        for text in utf8(batch.column("text")):
            before = len(hashes)
            for pos, line in enumerate(text.split(b"\n")):
                key = line_key(line)
                if key and (min_chars <= 1 or len(key.decode()) >= min_chars):
                    hashes.append(xxhash.xxh3_128_digest(key))
                    positions.append(pos)
            counts.append(len(hashes) - before)
        at = pa.array(np.repeat(np.arange(len(counts)), counts))
        pair = np.frombuffer(b"".join(hashes), dtype=">i8").reshape(-1, 2).astype(np.int64)
        return {
            "h1": pa.array(pair[:, 0]),
            "h2": pa.array(pair[:, 1]),
            "doc_id": batch.column("doc_id").take(at),
            "text_key": batch.column("text_key").take(at),
            "pos": pa.array(positions, type=pa.int32()),
        }

    picked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), content().alias("text"), text_key().alias("text_key")
    )
    return in_batches(picked, rows, _LINES)


class _Run:
    """The run of one hash that a batch's end has cut."""

    def __init__(self, key: tuple[int, int], first: bool):
        self.key, self.first, self.docs, self.last = key, first, 0, None
        self.held: list[pa.RecordBatch] = []
        self.begun = False

    def add(self, rows: pa.RecordBatch, docs: np.ndarray) -> None:
        self.docs += int(np.count_nonzero(docs[1:] != docs[:-1])) + (self.last != docs[0])
        self.last = docs[-1]
        self.held.append(rows)


def _verdicts(kind: int, rows: pa.RecordBatch, heads: np.ndarray, part: int) -> pa.RecordBatch:
    n = rows.num_rows
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, kind, np.int32)),
            *(rows.column(c) for c in ("h1", "h2", "doc_id", "text_key", "pos")),
            pa.array(heads),
            pa.array(np.zeros(n, np.int32)),
            pa.array(np.full(n, part, np.int32)),
        ],
        names=["kind", "h1", "h2", "doc_id", "text_key", "pos", "head", "n", "part"],
    )


def _stream(batches: Iterator[pa.RecordBatch], min_docs: int, keep_first: bool):
    part = TaskContext.get().partitionId()
    run: _Run | None = None

    def flush(run: _Run) -> Iterator[pa.RecordBatch]:
        """Passes on what a run that has reached min_docs holds."""
        for rows in run.held:
            heads = np.zeros(rows.num_rows, dtype=bool)
            heads[0] = not run.begun
            if keep_first and not run.begun:
                if run.first:  # whether it is the first of all, the reports tell
                    yield _verdicts(_PENDING, rows.slice(0, 1), heads[:1], part)
                rows, heads = rows.slice(1), heads[1:]
            run.begun = True
            if rows.num_rows:
                yield _verdicts(_DROP, rows, heads, part)
        run.held = []

    def close(run: _Run, last: bool) -> Iterator[pa.RecordBatch]:
        if run.docs >= min_docs:
            yield from flush(run)
        if not (run.first or last):
            return
        for rows in run.held:
            heads = np.zeros(rows.num_rows, dtype=bool)
            heads[0], run.begun = not run.begun, True
            yield _verdicts(_PENDING, rows, heads, part)
        one = [[_COUNT], [run.key[0]], [run.key[1]], [None], [None], [None], [False], [run.docs], [part]]
        types = [pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.bool_(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, type=t) for v, t in zip(one, types)],
            names=["kind", "h1", "h2", "doc_id", "text_key", "pos", "head", "n", "part"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
        ids = batch.column("doc_id")
        # A null id is a document of its own: told apart by a second column.
        docs = np.rec.fromarrays(
            [ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)]
        )
        fresh = np.ones(len(h1), dtype=bool)
        fresh[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        starts = np.flatnonzero(fresh)
        ends = np.append(starts[1:], len(h1))
        begin = 0
        if run is not None and run.key == (h1[0], h2[0]):
            run.add(batch.slice(0, ends[0]), docs[: ends[0]])
            if run.docs >= min_docs:
                yield from flush(run)
            begin = 1
        if begin < len(starts):
            if run is not None:
                yield from close(run, False)
            elif begin == 0 and len(starts) > 1:  # the partition's first run ends in this batch
                run = _Run((int(h1[0]), int(h2[0])), True)
                run.add(batch.slice(0, ends[0]), docs[: ends[0]])
                yield from close(run, False)
                begin = 1
            first = run is None
            # Runs that begin and end inside the batch.
            new_doc = fresh.copy()
            new_doc[1:] |= docs[1:] != docs[:-1]
            inner = slice(begin, len(starts) - 1)
            if starts[inner].size:
                low, high = starts[begin], ends[len(starts) - 2]
                n_docs = np.add.reduceat(new_doc[low:high].astype(np.int64), starts[inner] - low)
                hot = np.repeat(n_docs >= min_docs, ends[inner] - starts[inner])
                heads = fresh[low:high]
                if keep_first:
                    hot &= ~heads
                if hot.any():
                    at = np.flatnonzero(hot)
                    yield _verdicts(_DROP, batch.take(pa.array(at + low)), heads[at], part)
            at = starts[-1]
            run = _Run((int(h1[at]), int(h2[at])), first)
            run.add(batch.slice(at), docs[at:])
            if run.docs >= min_docs:
                yield from flush(run)
    if run is not None:
        yield from close(run, True)


def keep_bitmaps(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False
) -> DataFrame:
    """doc_id, text_key, n_dropped, keep_bitmap of every document that loses lines.

    Lines whose key occurs in `min_docs` documents or more are dropped, all of them or
    (`keep_first`) all but the first by doc_id and position. Bitmaps are zlib-packed
    bits, big end first; lines behind a bitmap's end stay.
    """
    lines = stored(line_rows(docs, min_chars), "lines")
    order = ("h1", "h2", "doc_id")
    runs = lines.repartitionByRange(*order).sortWithinPartitions(*order, "text_key", "pos")
    verdicts = stored(
        runs.mapInArrow(lambda batches: _stream(batches, min_docs, keep_first), _VERDICTS), "line-verdicts"
    )
    totals = (
        verdicts.where(F.col("kind") == _COUNT)
        .groupBy("h1", "h2")
        .agg(F.sum("n").alias("total"), F.min("part").alias("first_part"))
    )
    pending = verdicts.where(F.col("kind") == _PENDING).join(totals, ["h1", "h2"])
    pending = pending.where(F.col("total") >= min_docs)
    if keep_first:
        pending = pending.where(~(F.col("head") & (F.col("part") == F.col("first_part"))))
    drops = verdicts.where(F.col("kind") == _DROP).unionByName(pending.select(verdicts.columns))

    @F.pandas_udf("binary")
    def packed(dropped: pd.Series) -> pd.Series:
        def bits(positions) -> bytes:
            keep = np.ones(int(max(positions)) + 1, dtype=np.uint8)
            keep[positions] = 0
            # Bits past the last line are set: what is not listed stays.
            keep = np.append(keep, np.ones(-len(keep) % 8, dtype=np.uint8))
            return zlib.compress(np.packbits(keep).tobytes())

        return dropped.map(bits)

    # A document's own lines are no more than its text holds.
    return (
        drops.groupBy("doc_id", "text_key")
        .agg(F.collect_set("pos").alias("dropped"))
        .select(
            "doc_id",
            "text_key",
            F.size("dropped").cast("long").alias("n_dropped"),
            packed("dropped").alias("keep_bitmap"),
        )
    )


def kept_text(text: str, bitmap: bytes | None) -> str:
    if bitmap is None:
        return text
    lines = text.split("\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8))
    return "\n".join(x for i, x in enumerate(lines) if i >= len(keep) or keep[i])


def with_bitmaps(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """`rows` (doc_id, text_key and more) with n_dropped and keep_bitmap, null where
    nothing is dropped."""
    a, b = rows.alias("a"), bitmaps.alias("b")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_key") == F.col("b.text_key"))
    return a.join(b, same, "left").select("a.*", "b.n_dropped", "b.keep_bitmap")


def apply(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The documents with the dropped lines out of `text`; n_chars follows if there.

    A null text that loses nothing stays null.
    """

    @F.pandas_udf("string")
    def kept(text: pd.Series, bitmap: pd.Series) -> pd.Series:
        return pd.Series([kept_text(t, b) for t, b in zip(text, bitmap)], dtype=object)

    joined = with_bitmaps(whole_rows(docs), bitmaps)
    joined = joined.withColumn("row", F.col("row").withField("text", kept("row.text", "keep_bitmap")))
    if "n_chars" in docs.columns:
        shorter = F.char_length("row.text").cast(dict(docs.dtypes)["n_chars"])
        n_chars = F.when(F.col("keep_bitmap").isNull(), F.col("row.n_chars")).otherwise(shorter)
        joined = joined.withColumn("row", F.col("row").withField("n_chars", n_chars))
    return rows_again(joined, docs.columns)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows_of = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), content().alias("text")
    )
    joined = with_bitmaps(rows_of, keep_bitmaps(docs))

    def rows(batch: pa.RecordBatch) -> dict:
        texts = batch.column("text").to_pylist()
        kept = [
            hashlib.sha256(kept_text(t, b).encode()).hexdigest()
            for t, b in zip(texts, batch.column("keep_bitmap").to_pylist())
        ]
        return {
            "doc_id": batch.column("doc_id"),
            "n_lines": [t.count("\n") + 1 for t in texts],
            "n_dropped": batch.column("n_dropped").fill_null(0),
            "kept_sha256": kept,
        }

    picked = joined.select("doc_id", "text", "n_dropped", "keep_bitmap")
    return in_batches(picked, rows, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


QUERIES = {"op1_line_dedup": op1_line_dedup}

SQL = {
    "op1_line_dedup": r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
    FROM lines
), common AS (
    SELECT line_key FROM keyed WHERE length(line_key) >= 1
    GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(c.line_key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.line_key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c USING (line_key)
GROUP BY doc_id"""
}
