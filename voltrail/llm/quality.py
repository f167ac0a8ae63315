"""Quality classifier: a label model over heuristic labellers, and a hashed scorer.

Each labeller looks at one habit of a text and votes good, junk or not at all. How
often each combination of votes occurs is counted over all documents; expectation
maximisation on those counts estimates how far each labeller can be trusted and so the
probability that a document with these votes is good. A linear scorer on hashed word
shapes is fitted to these probabilities and decides about every document. No given
labels are used, so all of them can serve as a check.

The scorer is fitted on about SAMPLE documents, picked by a hash of theirs, never more
than twice as many. Votes, counts and scores cover all documents and whole texts.

Defined results: a null, empty or wordless text is no prose and is scored like any
other (it has neither votes nor features but its emptiness); equal texts have equal
scores; repeated rows stay repeated; an empty table gives no rows, and its model keeps
everything. Extra columns pass through `apply`.
"""

from __future__ import annotations

import operator
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail.llm.common import content, in_batches, stored, table, utf8

#: Documents the scorer is fitted on, about.
SAMPLE = 6_000
DIMENSIONS = 1 << 12
ROUNDS = 60
#: Votes that each labeller is credited with at the start.
IMAGINED = 20
#: Least, first and greatest share of right votes, of labellers for good and for junk.
BOUNDS = ((0.55, 0.7, 0.75), (0.9, 0.95, 0.98))
VOTING_GOOD = 3
#: Below one half: a doubtful document stays.
THRESHOLD = 0.4
#: Words over which variety is measured, in long texts at every place.
WINDOW = 499
#: Each names a habit; the first three vote good or not at all, the others junk or not
#: at all, and their habits overlap.
LABELLERS = (
    "plain", "flowing", "calm",
    "marks", "marked_words", "cells", "cell_lines", "stutter", "poor_words", "repeated_lines",
    "digits", "long_words", "shouting",
)
GOOD, JUNK = 1, -1

# Letters (and all bytes above ASCII) to a, digits to 0, white space to a blank.
_CLASSES = bytes(
    0x61 if c >= 0x80 or chr(c).isalpha() else 0x30 if chr(c).isdigit() else 0x20 if chr(c) in " \t\n\x0b\x0c\r" else c
    for c in range(256)
)
#: White space, and all that is no ASCII.
_NOT_PLAIN = bytes(range(0x80, 0x100)) + b" \t\n\x0b\x0c\r"
_LETTERS, _DIGITS, _BLANKS = re.compile(rb"a+"), re.compile(rb"0+"), b" "
_PROSE_MARKS = b".,;:!?'\"()-"
_ODD = b"#$%&*<>=~^_+|@!?"
_CELLS = {b"|", b"||", b"*", b"=", b"/", b"\\", b"+"}


@dataclass
class Traits:
    words: int
    votes: list[int]
    features: dict[int, float]


def _slot(name: bytes) -> int:
    return zlib.crc32(name) % DIMENSIONS


def variety(words: list[bytes], window: int = WINDOW) -> float:
    """Share of different words in a window, mean over all windows of the text; a
    shorter text is one window. So it does not fall with a text's length."""
    n = len(words)
    if n <= window:
        return len(set(words)) / n
    last: dict[bytes, int] = {}
    before = np.empty(n, dtype=np.int64)
    for i, word in enumerate(words):
        before[i] = last.get(word, -1)
        last[word] = i
    # A place counts in the windows that start behind the same word's place before it.
    place = np.arange(n)
    first = np.maximum(before + 1, place - window + 1)
    counted = np.minimum(place, n - window) - np.maximum(first, 0) + 1
    return float(np.maximum(counted, 0).sum() / (n - window + 1) / window)


def traits(text: bytes) -> Traits:
    words = text.split()
    n = len(words)
    if not n:
        return Traits(0, [0] * len(LABELLERS), {_slot(b"empty"): 1.0})
    classes = text.translate(_CLASSES)
    size = len(classes) - classes.count(_BLANKS)
    plain_size = len(text.translate(None, _NOT_PLAIN))
    letters, digits = classes.count(b"a"), classes.count(b"0")
    prose = sum(map(classes.count, (bytes((c,)) for c in _PROSE_MARKS)))
    marks = max(0, size - letters - digits - prose) / size
    again = sum(map(operator.eq, words, words[1:])) / max(1, n - 1)
    shapes = _DIGITS.sub(b"0", _LETTERS.sub(b"a", classes)).split()
    cells = sum(x in _CELLS for x in shapes) / n
    marked = sum(map(shapes.count, {x for x in set(shapes) if len(x) > 2 and x[-1] == x[-2] and x[-1] in _ODD})) / n
    ends = sum(x.endswith((b".", b"!", b"?")) for x in shapes)
    per_sentence = n / max(1, ends)
    lines = [x.strip() for x in text.split(b"\n") if x.strip()]
    repeated = 1 - len(set(lines)) / len(lines)
    gridded = sum(x.count(b" | ") + x.count(b"\t") > 3 for x in lines) / len(lines)
    varied = variety(words)
    capitals = sum(x[:1].isupper() for x in words) / n
    # A few words over and over are no text of the usual kind, however clean they look.
    poor = varied < 0.25 and n > 20
    good = (
        marks < 0.01 and cells < 0.01 and marked < 0.02 and not poor,
        again < 0.03 and cells < 0.01 and 3 <= per_sentence <= 40 and n > 8 and not poor,
        marks < 0.01 and again < 0.03 and marked < 0.02 and not poor,
    )
    junk = (
        marks > 0.04,
        marked > 0.15 and n > 4,
        cells > 0.1 and n > 4,
        gridded > 0.25,
        again > 0.15 and n > 4,
        poor,
        repeated > 0.5 and len(lines) > 4,
        digits / size > 0.4,
        # Scripts that set no blanks between words have long runs of other bytes.
        plain_size / n > 16,
        capitals > 0.8 and n > 12,
    )
    votes = [*(GOOD * x for x in good), *(JUNK * x for x in junk)]
    counts = Counter(shapes)
    counts.update(a + b" " + b for a, b in zip(shapes, shapes[1:]))
    total = len(shapes)
    features: dict[int, float] = {}
    for shape, count in counts.items():
        slot = _slot(b"s:" + shape)
        features[slot] = features.get(slot, 0.0) + float(np.sqrt(count / total))
    for name, value in ((b"stutter", again), (b"lines", repeated), (b"variety", 1 - varied), (b"poor", poor)):
        slot = _slot(b"t:" + name)
        features[slot] = features.get(slot, 0.0) + float(np.sqrt(value))
    return Traits(n, votes, features)


def described(docs: DataFrame) -> DataFrame:
    """doc_id, order (a hash), votes, slots and weights of every row."""

    def rows(batch: pa.RecordBatch) -> dict:
        found = [traits(t) for t in utf8(batch.column("text"))]
        return {
            "doc_id": batch.column("doc_id"),
            "order": batch.column("order"),
            "votes": [t.votes for t in found],
            "slots": [list(t.features) for t in found],
            "weights": [list(t.features.values()) for t in found],
        }

    doc_id = F.col("doc_id").cast("long")
    picked = docs.select(
        doc_id.alias("doc_id"), F.xxhash64(doc_id, content()).alias("order"), content().alias("text")
    )
    return in_batches(
        picked, rows, "doc_id long, order long, votes array<tinyint>, slots array<int>, weights array<float>"
    )


def label_model(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) per vote pattern, and how often each labeller's votes are right.

    Given the class, labellers err independently, and not voting tells nothing. A vote
    for junk names a fault that was seen, one for good only says that some faults are
    missing on a text of the usual kind: BOUNDS keeps the estimates to that order, so
    that a corpus with little junk is not explained away, nor one without it cut in two.
    """
    kind = (np.arange(patterns.shape[1]) >= VOTING_GOOD).astype(int)
    low, first, high = (np.array([b[i] for b in BOUNDS])[kind] for i in range(3))
    voted = (patterns != 0) * counts[:, None]
    right, share = first, 0.8
    for _ in range(ROUNDS):
        logit = np.log(share / (1 - share)) + patterns @ np.log(right / (1 - right))
        good = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        agree = np.where(patterns > 0, good[:, None], 1 - good[:, None])
        right = ((voted * agree).sum(0) + first * IMAGINED) / (voted.sum(0) + IMAGINED)
        right = np.clip(right, low, high)
        share = float(np.clip((good @ counts + 0.8 * IMAGINED) / (counts.sum() + IMAGINED), 0.5, 0.9))
    return good, right


def fit_scorer(rows: list, good: list[float], steps: int = 400) -> np.ndarray:
    """Logistic weights (last: constant) on hashed features, fitted to probabilities."""
    weights = np.zeros(DIMENSIONS + 1)
    if not rows:
        return weights
    x = np.zeros((len(rows), DIMENSIONS + 1), dtype=np.float32)
    for i, row in enumerate(rows):
        x[i, row["slots"]] = row["weights"]
        x[i, DIMENSIONS] = 1.0
    used = np.flatnonzero(x.any(axis=0))
    x = x[:, used]
    y = np.asarray(good, dtype=np.float32)
    balance = np.where(y > 0.5, 0.5 / max(y.mean(), 0.05), 0.5 / max(1 - y.mean(), 0.05)).astype(np.float32)
    w, m, v = (np.zeros(len(used), dtype=np.float32) for _ in range(3))
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (balance * (p - y)) / len(y) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights[used] = w
    return weights


def train(rows: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The scorer's weights, from the votes of all `rows` (see `described`)."""
    # At most 3 to the power of the labellers' number.
    patterns = rows.groupBy("votes").count().collect()
    if not patterns:
        return np.zeros(DIMENSIONS + 1)
    votes = np.array([r["votes"] for r in patterns], dtype=int)
    good, _ = label_model(votes, np.array([r["count"] for r in patterns], dtype=float))
    known = {tuple(v): g for v, g in zip(votes.tolist(), good)}
    # About `sample` rows by their hash; the limit only holds back a row repeated without end.
    share = min(1.0, sample / sum(r["count"] for r in patterns))
    picked = rows.where(F.pmod("order", F.lit(1 << 30)) < int(share * (1 << 30)))
    some = picked.select("votes", "slots", "weights").limit(2 * sample).collect()
    return fit_scorer(some, [known[tuple(r["votes"])] for r in some])


def chance(slots, weights, model: np.ndarray) -> float:
    z = float(np.dot(model[np.asarray(slots, dtype=int)], np.asarray(weights, dtype=float)) + model[-1])
    return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def scored(rows: DataFrame, model: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    def score(batch: pa.RecordBatch) -> dict:
        slots, weights = batch.column("slots").to_pylist(), batch.column("weights").to_pylist()
        scores = [chance(s, w, model) for s, w in zip(slots, weights)]
        return {
            "doc_id": batch.column("doc_id"),
            "score": scores,
            "keep": [s >= threshold for s in scores],
        }

    return in_batches(rows, score, "doc_id long, score double, keep boolean")


def apply(docs: DataFrame, model: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the scorer keeps, all columns as they were; nothing moves."""

    @F.pandas_udf("boolean")
    def keeps(texts: pd.Series) -> pd.Series:
        found = (traits((t or "").encode()) for t in texts)
        return pd.Series(
            [chance(list(t.features), list(t.features.values()), model) >= threshold for t in found]
        )

    return docs.where(keeps(content()))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(described(table(spark, sf_dir, "documents")), "quality-traits")
    return scored(rows, train(rows))


QUERIES = {"op6_quality_classifier": op6_quality_classifier}
SQL: dict[str, str] = {}
