"""Conversation structure repair: the cheapest edits, found as integer-minimum paths.

A conversation is read by turn; every row is kept, reroled or deleted, and empty rows may
be inserted, until the roles read `(s?(ua)+)?`. The nodes of the DAG are (rows read, place
in that pattern: nothing yet, after s, after u, after a). A path's weight is one integer:
the cost in the high digits, below it the audit letters as fixed-width digits from the
left, with zeros behind the last one. D, I, K, R are 1 to 4, so of equal costs the
smaller integer is the ASCII-least audit. At a node, equal costs with one audit a prefix of the other
cannot meet (the longer one would hold more insertions, which cost), so taking the least
integer at each node is exact, and adding an edge's integer keeps the order.

Long conversations: letters that all places agree on are final. They leave the integers,
which are shifted up; if places do not agree, the integers get more digits instead (in a
conversation of user rows alone, one insertion may wait for the end to find its place).

Three steps, each combined or streamed: the first turn of each (conversation, role, digest
of the text) tells which rows repeat an earlier one; a stream of narrow rows, sorted within
each conversation, gives counts and edits; a second stream carries out the edits on the
texts, row by row, none held back. Both streams read a conversation in one task, since one SHA-256
must run over its rows in order; what the task holds is three bits per undecided letter and
the audit that it returns.

Defined results: nulls become one space before anything else, but a null conv_id stays
one conversation with conv_id null, and null turns come first. Rows of one turn are read
by role, then by the SHA-256 of their text; all of them share the turn's damage. Roles
other than s…, u…, a… cannot be kept. Only the four columns are read, so others may have
any name; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail.llm.common import SPACES, table

#: Letters by digit; digit 0 pads.
LETTERS = " DIKR"
_DELETE, _INSERT, _KEEP, _REROLE = 1, 2, 3, 4
_BITS = 3
#: Letters an integer holds at first.
WINDOW = 96
#: Places in the pattern.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: Where a role of this initial leads from each place.
_STEPS = {
    "s": ((_START, _SYSTEM),),
    "u": ((_START, _USER), (_SYSTEM, _USER), (_ASSISTANT, _USER)),
    "a": ((_USER, _ASSISTANT),),
}
_FREE = _STEPS["u"] + _STEPS["a"]
_LEGAL = ("su", "ua", "au")


class Paths:
    """Least weights per place; `push` takes a row, `settled` and `finish` give letters."""

    def __init__(self, window: int = WINDOW):
        self.window, self.base = window, 0
        self.best: list[tuple[int, int] | None] = [(0, 0), None, None, None]
        self._insert(self.best)

    def _edge(self, path: tuple[int, int], cost: int, letter: int) -> tuple[int, int]:
        weight, length = path
        return (
            weight + (cost << (_BITS * self.window)) + (letter << (_BITS * (self.window - 1 - length))),
            length + 1,
        )

    def _insert(self, best: list) -> None:
        for _ in range(2):
            for a, b in _FREE:
                if best[a] is not None:
                    path = self._edge(best[a], 2, _INSERT)
                    if best[b] is None or path < best[b]:
                        best[b] = path

    def push(self, initial: str, must_delete: bool, truncated: bool) -> None:
        if max(p[1] for p in self.best if p) + 3 >= self.window:
            self._grow()
        best = [p and self._edge(p, 3, _DELETE) for p in self.best]
        if not must_delete:
            for steps, cost, letter in (
                (_STEPS.get(initial, ()), int(truncated), _KEEP),
                (_FREE, 2 + int(truncated), _REROLE),
            ):
                for a, b in steps:
                    if self.best[a] is not None:
                        path = self._edge(self.best[a], cost, letter)
                        if best[b] is None or path < best[b]:
                            best[b] = path
        self._insert(best)
        self.best = best
        self._forget()

    def _forget(self) -> None:
        """Drops places that cannot win any more: whatever follows from `after s` follows
        from `after a` too, and from the start all but one system row, deleted for 3."""
        high = _BITS * self.window
        end = self.best[_ASSISTANT]
        for place, more in ((_START, 3), (_SYSTEM, 0)):
            if end and self.best[place] and (self.best[place][0] >> high) > (end[0] >> high) + more:
                self.best[place] = None

    def _grow(self) -> None:
        self.best = [p and (p[0] << (_BITS * self.window), p[1]) for p in self.best]
        self.window *= 2

    def settled(self) -> str:
        """The letters all places agree on; they leave the weights."""
        live = [p for p in self.best if p]
        high = _BITS * self.window
        low = (1 << high) - 1
        digits = [p[0] & low for p in live]
        apart = 0
        for d in digits[1:]:
            apart |= d ^ digits[0]
        common = min((high - apart.bit_length()) // _BITS, min(p[1] for p in live))
        if common <= 0:
            return ""
        letters = self._letters(digits[0], common)
        least = min(p[0] >> high for p in live)
        self.base += least
        self.best = [
            p and ((((p[0] >> high) - least) << high) | ((p[0] << (_BITS * common)) & low), p[1] - common)
            for p in self.best
        ]
        return letters

    def _letters(self, digits: int, count: int) -> str:
        text = digits >> (_BITS * (self.window - count))
        # Three bits a digit: octal writes one figure for each.
        return f"{text:0{count}o}".translate(str.maketrans("01234", LETTERS)) if count else ""

    def finish(self) -> tuple[int, str]:
        """Cost of the cheapest edits, and the letters not given out yet."""
        weight, length = min(p for p in (self.best[_START], self.best[_ASSISTANT]) if p)
        high = _BITS * self.window
        return self.base + (weight >> high), self._letters(weight & ((1 << high) - 1), length)


class Judged:
    """Counts and cheapest edits of one conversation, row by row, without its texts."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.paths, self.audit = conv_id, Paths(), []
        self.open, self.settle_at = 0, WINDOW // 2
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.initial = self.marked = self.last = None

    def mark(self, key: tuple) -> None:
        """Rows of this turn, role and digest have an equal row in an earlier turn."""
        self.marked = key

    def row(self, key: tuple, blank: bool, truncated: bool) -> None:
        turn, role, _ = key
        repeated = not blank and (key == self.marked or key == self.last)
        truncated = truncated and not blank and not repeated
        self.last = key
        self.blank += blank
        self.duplicate += repeated
        self.truncated += truncated
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in _LEGAL
        self.initial = initial
        self.paths.push(initial, blank or repeated, truncated)
        self.open += 1
        if self.open >= self.settle_at:
            letters = self.paths.settled()
            self.audit.append(letters)
            self.open = max(0, self.open - len(letters))
            self.settle_at = max(WINDOW // 2, 2 * self.open)

    def result(self) -> tuple:
        cost, letters = self.paths.finish()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost)
        return (self.conv_id, *counts, "".join(self.audit) + letters)


class Repaired:
    """Digest of a conversation's rows after the edits of its audit."""

    def __init__(self, judged: tuple):
        self.judged, self.audit, self.at = judged, judged[-1], 0
        self.digest, self.written, self.place = hashlib.sha256(), False, _START

    def _write(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.written else "") + role + ":" + text).encode())
        self.written = True

    def _next_role(self) -> str:
        self.place = _ASSISTANT if self.place == _USER else _USER
        return "user" if self.place == _USER else "assistant"

    def _insertions(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._write(self._next_role(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._insertions()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K" and role[:1] == "s":
            self.place = _SYSTEM
            self._write(role, text)
        elif letter != "D":
            wanted = self._next_role()
            self._write(role if letter == "K" else wanted, text)

    def result(self) -> tuple:
        self._insertions()
        return (*self.judged, self.digest.hexdigest())


_JUDGED = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)
_OUT = _JUDGED + ", repaired_sha256 string"
#: Kinds of rows in the streams, in the order they stand in.
_DROPPED, _EDITS, _MARKER, _ROW = range(4)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and `copies` after the contract's damage; dropped rows have
    0 copies and no text."""
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    shown = [F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, turn)]
    hit = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        conv.alias("conv_id"),
        turn.alias("turn"),
        F.when(hit == 4, F.lit("user")).when(hit != 0, role).otherwise(F.lit("")).alias("role"),
        F.when(hit.isin(0, 1), F.lit("")).when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"),
    )


def repeated(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest of rows that have an equal one in an earlier turn."""
    at = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    narrow = rows.where((F.col("kind") == _ROW) & ~F.col("blank")).select(
        "conv_id", "turn", "role", "digest", at.alias("at")
    )
    first = narrow.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    a, b = narrow.alias("a"), first.where("first < last").alias("b")
    same = (
        F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))
        & (F.col("a.role") == F.col("b.role"))
        & (F.col("a.digest") == F.col("b.digest"))
    )
    return a.join(b, same).where("a.at > b.first").select("a.conv_id", "a.turn", "a.role", "a.digest")


def _streamed(df: DataFrame, begin, step, schema: str) -> DataFrame:
    """One row per conversation of a sorted stream: `begin` makes the state at its first row,
    `step` takes the state and each row, the state's `result` is the row."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def made(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv = None, None
        for batch in batches:
            done = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or row[0] != conv:
                    if now is not None:
                        done.append(now.result())
                    conv, now = row[0], begin(row)
                step(now, row)
            if done:
                yield made(done)
        if now is not None:
            yield made([now.result()])

    return df.mapInArrow(run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """Counts, cost, audit and digest per conversation of `damaged` rows (any rows with
    conv_id, turn, role, text and copies)."""
    ended = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = rows.select(
        "conv_id",
        "turn",
        "role",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.when(F.col("copies") == 0, _DROPPED).otherwise(_ROW).alias("kind"),
        "copies",
        (ended == "").alias("blank"),
        (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("truncated"),
        "text",
    )

    def judge(now: Judged, row: tuple) -> None:
        _, turn, role, digest, kind, copies, blank, truncated = row
        if kind == _MARKER:
            now.mark((turn, role, digest))
        elif kind == _ROW:
            for _ in range(copies):
                now.row((turn, role, digest), blank, truncated)

    def carry_out(now: Repaired, row: tuple) -> None:
        _, role, kind, copies, text, _ = row
        if kind == _ROW:
            for _ in range(copies):
                now.row(role, text)

    order = ("conv_id", "turn", "role", "digest", "kind")
    markers = repeated(rows).select("*", F.lit(_MARKER).alias("kind"))
    narrow = rows.drop("text").unionByName(markers, allowMissingColumns=True)
    narrow = narrow.repartition("conv_id").sortWithinPartitions(*order)
    judged = _streamed(narrow, lambda row: Judged(row[0]), judge, _JUDGED)
    # A conversation's edits stand before its rows; dropped rows are not needed any more.
    edits = judged.select("conv_id", F.lit(_EDITS).alias("kind"), F.struct(*judged.columns).alias("edits"))
    texts = rows.where(F.col("kind") == _ROW).select("conv_id", "turn", "role", "digest", "kind", "copies", "text")
    stream = texts.unionByName(edits, allowMissingColumns=True).repartition("conv_id")
    stream = stream.sortWithinPartitions("conv_id", F.col("kind"), *order[1:4])
    stream = stream.select("conv_id", "role", "kind", "copies", "text", "edits")
    return _streamed(stream, lambda row: Repaired(tuple(row[5].values())), carry_out, _OUT)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))


QUERIES = {"op13_conversation_repair": op13_conversation_repair}
SQL: dict[str, str] = {}
