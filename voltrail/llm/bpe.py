"""Byte-level BPE as a lazily determinised finite-state transducer.

A prefix of a piece has one BPE encoding. Its last token is the one suffix of the
prefix that is a token and forms a valid pair with the last token of what comes
before it. A later token can only start at a position from which the bytes read so
far are the beginning of some token; those few positions are the *live* ones. A
transducer state is, for each live position, what is read since and how the token
before it acts on what follows; an arc gives the last token of the longer prefix.
Tokens that all live positions have behind them are final and are emitted, so
lookahead is bounded by the longest token. States and arcs are made when first met
and kept in a bounded table.

Texts are encoded some at a time. The distinct pieces of those texts that are not known yet
step through the transducer together, one byte of all of them at a time: the arcs are a
hash table of (state, byte) in plain arrays, looked up for all pieces at once, and only arcs
that nobody has met are made one by one. What is kept of a piece is its ids. Long pieces are
encoded by themselves, as a stream.

Decoding concatenates token bytes and hands out text through an incremental UTF-8
state machine, so a character may be spread over chunks.

Defined results: null or empty text has no tokens (and the digest of nothing);
repeated rows give repeated rows; extra columns of `encode` pass through untouched.
Texts of any length are cut at places where the pattern always ends a piece.
"""

from __future__ import annotations

import base64
import codecs
import gc
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail.llm.common import content, in_batches, table

#: States kept before the table starts anew, pieces kept likewise. Bounds of memory
#: only: what is forgotten is made again.
MAX_STATES = 400_000
MAX_PIECES = 100_000
#: Characters of texts that are encoded together, and bytes of a piece that is short.
GROUP = 1 << 18
SHORT = 64
#: Texts longer than this many characters are handled in parts.
PART = 1 << 20
#: Bytes of a long piece after which final tokens are emitted.
WINDOW = 1 << 12

_NEVER = 1 << 60
#: Pieces that step together.
_TOGETHER = 1 << 13
#: Rows of a batch whose texts are Python strings at a time.
_ROWS = 128


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    pairs = (line.split() for line in raw.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Transducer:
    """Encodes pieces; see the module's docstring."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._spell()
        #: Length of each token met, by id.
        self.widths = np.ones(max(ranks.values()) + 1, np.int64)
        self.max_states = max_states
        self.edges: tuple[dict, dict] = ({}, {})
        # Right edges that act alike share a number; 0 stands for the piece's start.
        self.kinds: dict[tuple, int] = {(): 0}
        self.borders: list[tuple] = [()]
        self.kind_of: dict[int, int] = {}
        self._clear()

    def _spell(self) -> None:
        """Numbers the beginnings of tokens: 0 is the empty one; of the others, which byte leads
        from one to the next, how many bytes it has, its rank if it is a token, and whether
        a longer token begins so."""
        self.longer: dict[int, int] = {}
        self.depths, self.spelled, self.goes_on = [0], [-1], [True]
        for token, rank in self.ranks.items():
            node = 0
            for depth, byte in enumerate(token, 1):
                self.goes_on[node] = True
                key = node << 8 | byte
                node = self.longer.get(key, 0)
                if not node:
                    node = self.longer[key] = len(self.depths)
                    self.depths.append(depth)
                    self.spelled.append(-1)
                    self.goes_on.append(False)
            self.spelled[node] = rank

    def starts(self, part: bytes) -> bool:
        """Whether a token that is longer begins so."""
        node = 0
        for byte in part:
            node = self.longer.get(node << 8 | byte, 0)
            if not node:
                return False
        return self.goes_on[node]

    def _clear(self) -> None:
        # A state: per live position from the longest read part to the shortest, that
        # part's number and (lower half) the kind of the token before it.
        first = (0,)
        self.ids = {first: 0}
        self.states = [first]
        self.arcs: dict[int, tuple[int, int, int]] = {}
        self.known_fits: dict[int, bool] = {}
        # Arcs, and those met at the end of a piece only: what comes after is not made.
        self.known, self.closing = Arcs(), Arcs()

    def kind(self, token: int) -> int:
        known = self.kind_of.get(token)
        if known is None:
            border = tuple(x for x in self.edge(self.tokens[token], 1) if self.starts(x[0]))
            known = self.kinds.setdefault(border, len(self.borders))
            if known == len(self.borders):
                self.borders.append(border)
            self.kind_of[token] = known
        return known

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """What the last merge of a token joins; None if merging never gives the token."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            rank, at = min(
                (self.ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1)
            )
            if rank == _NEVER:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[1])

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int]] | None:
        """The parts that stand at one end (0 left, 1 right) of a token while it is
        merged, each with the rank of the merge that takes it up."""
        known = self.edges[side].get(token, self)
        if known is self:
            known, part, until = [], token, _NEVER
            while known is not None:
                known.append((part, until))
                if len(part) == 1:
                    break
                split, until = self.halves(part), self.ranks[part]
                if split is None:
                    known = None
                else:
                    part = split[side]
            self.edges[side][token] = known
        return known

    def fits(self, kind: int, token: bytes) -> bool:
        """Whether merging leaves a token apart from one of this kind before it: no merge
        across the border takes up a part before its own merge does (of equal ranks
        the left one comes first)."""
        side, border, ranks = self.edge(token, 0), self.borders[kind], self.ranks
        if side is None:
            return False
        for part, until in side:
            for before, before_until in border:
                rank = ranks.get(before + part)
                if rank is not None and rank < before_until and rank <= until:
                    return False
        return True

    def _state(self, state: tuple) -> int:
        number = self.ids.setdefault(state, len(self.states))
        if number == len(self.states):
            self.states.append(state)
        return number

    def _arc(self, at: int, byte: int) -> tuple[int, int, int]:
        """Next state, and the last token of what is read with its length."""
        longer, goes_on = self.longer, self.goes_on
        last, size = self._last(at, byte)
        grown = []
        for live in self.states[at]:
            node = longer.get(live >> 32 << 8 | byte)
            if node is not None and goes_on[node]:
                grown.append(node << 32 | live & _HALF)
        kind = self.kind_of.get(last)
        grown.append(self.kind(last) if kind is None else kind)
        return self._state(tuple(grown)), last, size

    def _last(self, at: int, byte: int) -> tuple[int, int]:
        """The last token of what is read, with its length."""
        longer, spelled, fits = self.longer, self.spelled, self.known_fits
        for live in self.states[at]:
            node = longer.get(live >> 32 << 8 | byte)
            if node is None:
                continue
            rank = spelled[node]
            if rank >= 0:
                pair = (live & _HALF) << 32 | rank
                fit = fits.get(pair)
                if fit is None:
                    fit = fits[pair] = self.fits(live & _HALF, self.tokens[rank])
                if fit:
                    return rank, self.depths[node]
        raise ValueError("the vocabulary lacks a single byte")

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > self.max_states:
            self._clear()
        out: list[int] = []
        at, arcs = 0, self.arcs
        lasts: list[tuple[int, int, int]] = []
        for byte in piece:
            arc = arcs.get(at << 8 | byte)
            if arc is None:
                arc = arcs[at << 8 | byte] = self._arc(at, byte)
            lasts.append(arc)
            at = arc[0]
            if len(lasts) >= 2 * WINDOW:
                done = self._emit(lasts, at, out)
                del lasts[:done]
                if len(self.states) > 2 * self.max_states:  # within one very long piece
                    state = self.states[at]
                    self._clear()
                    arcs, at = self.arcs, self._state(state)
        tail, i = [], len(lasts)
        while i > 0:
            _, token, size = lasts[i - 1]
            tail.append(token)
            i -= size
        out.extend(reversed(tail))
        return out

    def encode_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of short pieces, all of them stepped together, and where each one's end."""
        if len(self.states) > self.max_states or self.closing.count > 2 * self.max_states:
            self._clear()
        sizes = np.array([len(p) for p in pieces])
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        text = np.frombuffer(b"".join([pieces[i] for i in order.tolist()]), np.uint8)
        lasts = np.zeros((int(sizes[0]), len(order)), np.int32)
        at = np.zeros(len(order), np.int64)
        for step in range(int(sizes[0])):
            # Longest first: those still going are the first ones.
            going = int(np.searchsorted(-sizes, -step, "left"))
            on = int(np.searchsorted(-sizes, -step - 1, "left"))
            keys = at[:going] * 256 + text[starts[:going] + step]
            at, lasts[step, :on] = self._step(keys[:on])
            lasts[step, on:going] = self._end(keys[on:])
        # From the ends back: each last token leads to the place before it.
        width = self.widths
        place, going = sizes.copy(), np.arange(len(order))
        tails, counts = [], np.zeros(len(order), np.int64)
        while going.size:
            token = lasts[place[going] - 1, going]
            tails.append((going, token))
            counts[going] += 1
            place[going] -= width[token]
            going = going[place[going] > 0]
        # Numbers of ids in the order of the pieces, then each piece's ids from its end.
        place = np.empty_like(counts)
        place[order] = counts
        ends = np.cumsum(place)
        free = ends[order]
        ids = np.empty(int(ends[-1]), "<u4")
        for going, token in tails:
            free[going] -= 1
            ids[free[going]] = token
        return ids, ends

    def _step(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and last tokens of arcs, given as state * 256 + byte."""
        at, token = self.known.find(keys)
        new = np.flatnonzero(at < 0)
        if new.size:
            made = np.unique(keys[new])
            arcs = np.array([self._arc(key >> 8, key & 255) for key in made.tolist()], np.int64)
            self.known.add(made, arcs[:, 0], arcs[:, 1])
            self.widths[arcs[:, 1]] = arcs[:, 2]
            at[new], token[new] = self.known.find(keys[new])
        return at, token

    def _end(self, keys: np.ndarray) -> np.ndarray:
        """Last tokens of arcs that pieces end with."""
        at, token = self.known.find(keys)
        other = np.flatnonzero(at < 0)
        if other.size:
            there, token[other] = self.closing.find(keys[other])
            new = other[there < 0]
            if new.size:
                made = np.unique(keys[new])
                ends = np.array([self._last(key >> 8, key & 255) for key in made.tolist()], np.int64)
                self.closing.add(made, np.zeros(len(made), np.int64), ends[:, 0])
                self.widths[ends[:, 0]] = ends[:, 1]
                token[new] = self.closing.find(keys[new])[1]
        return token

    def _emit(self, lasts: list[tuple[int, int, int]], at: int, out: list[int]) -> int:
        """Emits what all live positions have in common; returns how many bytes it is."""
        ways = []
        for live in self.states[at]:
            i, way = len(lasts) - self.depths[live >> 32], []
            while i > 0:
                way.append(lasts[i - 1][1])
                i -= lasts[i - 1][2]
            ways.append(way[::-1])
        done = 0
        for tokens in zip(*ways):
            if len(set(tokens)) > 1:
                break
            out.append(tokens[0])
            done += len(self.tokens[tokens[0]])
        return done


class Arcs:
    """Arcs by key, in arrays: open addressing, doubled when half full."""

    def __init__(self) -> None:
        self.count = 0
        self._make(1 << 16)

    def _make(self, slots: int) -> None:
        self.shift, self.keys = 64 - slots.bit_length() + 1, np.full(slots, -1, np.int64)
        self.state, self.token = np.zeros(slots, np.int32), np.zeros(slots, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is, or the free slot it would take."""
        mask = len(self.keys) - 1
        slots = ((keys.astype(np.uint64) * _SPREAD) >> np.uint64(self.shift)).astype(np.int64)
        here = self.keys[slots]
        off = np.flatnonzero((here != keys) & (here >= 0))
        while off.size:
            slots[off] = (slots[off] + 1) & mask
            here = self.keys[slots[off]]
            off = off[(here != keys[off]) & (here >= 0)]
        return slots

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States and tokens of the keys; states of -1 for those that are not there."""
        slots = self._slots(keys)
        there = self.keys[slots] == keys
        return np.where(there, self.state[slots], np.int64(-1)), self.token[slots]

    def add(self, keys: np.ndarray, states: np.ndarray, tokens: np.ndarray) -> None:
        """Keys that are not there, each once."""
        self.count += len(keys)
        if 2 * self.count > len(self.keys):
            old = self.keys >= 0
            held = self.keys[old], self.state[old], self.token[old]
            self._make(1 << (2 * self.count).bit_length())
            self._put(*held)
        self._put(keys, states, tokens)

    def _put(self, keys: np.ndarray, states: np.ndarray, tokens: np.ndarray) -> None:
        while keys.size:
            slots = self._slots(keys)
            self.keys[slots] = keys
            # Of keys that took the same slot one is there; the others go on looking.
            there = self.keys[slots] == keys
            self.state[slots[there]], self.token[slots[there]] = states[there], tokens[there]
            keys, states, tokens = keys[~there], states[~there], tokens[~there]


_HALF = (1 << 32) - 1
#: An odd number that spreads keys over the slots.
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Codec(dict):
    """Pieces to their ids, as bytes of four each, by the transducer."""

    def __init__(self, raw: bytes, pattern: str):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.passing: dict[str, bytes] = {}
        ranks = parse_ranks(raw)
        self.transducer = Transducer(ranks)
        # The tiktoken library takes \s as Unicode's White_Space. A run at the end of an alternative
        # never gives anything back, and the endings behind an apostrophe are looked at together.
        self.pattern = regex.compile(
            pattern.replace(r"[^\s", r"[^\p{White_Space}")
            .replace(r"\S", r"\P{White_Space}")
            .replace(r"\s", r"\p{White_Space}")
            .replace("+|", "++|")
            .replace("'s|'t|'re|'ve|'m|'ll|'d|", "'(?:s|t|re|ve|m|ll|d)|")
        )
        #: Between a letter and a blank before a letter every piece ends.
        self.safe_cut = regex.compile(r"(?<=\p{L})(?= \p{L})")
        size = max(ranks.values()) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        # By id: its bytes in one array, and its decimal text with a space behind.
        self.sizes = np.array([len(t) for t in self.bytes_of])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        decimals = [b"%d " % i for i in range(size)]
        self.digits = np.array([len(d) for d in decimals])
        wide = int(self.digits.max())
        self.decimals = np.frombuffer(b"".join(d.ljust(wide) for d in decimals), np.uint8).reshape(size, wide)
        self.shown = np.arange(wide) < self.digits[:, None]

    def __missing__(self, piece: str) -> bytes:
        return self.passing[piece]

    def learn(self, pieces: set[str]) -> None:
        """Sees to it that these pieces are known. Long ones only until the next call."""
        if len(self) >= MAX_PIECES:
            self.older = dict(self)
            self.clear()
        self.passing = {}
        ranks, short, older = self.transducer.ranks, [], self.older
        # Set operations with a dictionary would run through the whole of it.
        for piece in list(filterfalse(self.__contains__, pieces)):
            again = older.get(piece)
            if again is not None:
                self[piece] = again
                continue
            text = piece.encode()
            whole = ranks.get(text)
            if whole is not None:
                self[piece] = whole.to_bytes(4, "little")
            elif len(text) > SHORT:
                self.passing[piece] = np.array(self.transducer.encode(text), "<u4").tobytes()
            else:
                short.append((piece, text))
        for at in range(0, len(short), _TOGETHER):
            some = short[at : at + _TOGETHER]
            ids, ends = self.transducer.encode_all([text for _, text in some])
            raw, start = ids.tobytes(), 0
            for (piece, _), end in zip(some, (4 * ends).tolist()):
                self[piece] = raw[start:end]
                start = end

    def parts(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > PART:
            cut = self.safe_cut.search(text, start + PART)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:] if start else text

    def encode_group(self, texts: Iterable[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """Texts, some at a time: their places (a long text has several), the ids of all of
        them, and where each one's ids end."""
        group, size = [], 0
        for place, text in enumerate(texts):
            for part in self.parts(text):
                group.append((place, self.pattern.findall(part)))
                size += len(part)
                if size >= GROUP:
                    yield self._group(group)
                    group, size = [], 0
        if group:
            yield self._group(group)

    def _group(self, group: list[tuple[int, list[str]]]) -> tuple[list[int], np.ndarray, np.ndarray]:
        self.learn(set(chain.from_iterable(pieces for _, pieces in group)))
        raw = [b"".join(map(self.__getitem__, pieces)) for _, pieces in group]
        ends = np.cumsum([len(r) // 4 for r in raw])
        return [place for place, _ in group], np.frombuffer(b"".join(raw), "<u4"), ends

    def encode(self, text: str) -> Iterator[list[int]]:
        """The ids in chunks."""
        for _, ids, _ in self.encode_group([text]):
            yield ids.tolist()

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in texts]
        for places, ids, ends in self.encode_group(texts):
            for place, one in zip(places, np.split(ids, ends[:-1])):
                out[place] += one.tolist()
        return out

    def written(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Decimal ids with a space behind each, cut at `ends`."""
        text = self.decimals[ids][self.shown[ids]].tobytes()
        return _cut(text, self.digits[ids], ends)

    def raw(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes that ids stand for, cut at `ends`."""
        sizes = self.sizes[ids]
        before = np.cumsum(sizes) - sizes
        at = np.repeat(self.starts[ids] - before, sizes)
        at += np.arange(len(at))
        return _cut(self.all_bytes[at].tobytes(), sizes, ends)

    def decode(self, chunks: Iterable[list[int]]) -> Iterator[str]:
        """Text of id chunks; bytes that are no UTF-8 become replacement characters."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in chunks:
            yield machine.decode(b"".join(map(self.bytes_of.__getitem__, ids)))
        yield machine.decode(b"", True)


def _cut(text: bytes, sizes: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """A group's text by its texts; `sizes` are those of its ids."""
    places = np.concatenate([[0], np.cumsum(sizes)])[ends].tolist()
    return [text[a:b] for a, b in zip([0, *places], places)]


_codecs: dict[tuple[bytes, str], Codec] = {}


def codec(raw: bytes, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    key = (hashlib.sha256(raw).digest(), pattern)
    if key not in _codecs:
        # Millions of small lasting tuples and no cycles: full collections find nothing.
        gc.set_threshold(200_000, 20, 10_000)
        _codecs.clear()
        _codecs[key] = Codec(raw, pattern)
    return _codecs[key]


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    """The texts of a batch, a few at a time: as Python strings they take several times
    the room."""
    column = batch.column("text")
    for start in range(0, len(column), _ROWS):
        for text in column.slice(start, _ROWS).to_pylist():
            yield text or ""


def digests(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Per row: token count, digest of the ids, digest of the bytes they decode to."""

    def rows(batch: pa.RecordBatch) -> dict:
        own, n_rows = codec(ranks, pattern), batch.num_rows
        counts = [0] * n_rows
        of_ids, of_text = ([hashlib.sha256() for _ in range(n_rows)] for _ in range(2))
        machines = [None] * n_rows
        for rows, ids, ends in own.encode_group(_texts(batch)):
            starts = [0, *ends.tolist()]
            for row, start, end, decimal, raw in zip(
                rows, starts, starts[1:], own.written(ids, ends), own.raw(ids, ends)
            ):
                if start == end:
                    continue
                machine = machines[row] = machines[row] or codecs.getincrementaldecoder("utf-8")("replace")
                of_ids[row].update((b" " if counts[row] else b"") + decimal[:-1])
                of_text[row].update(machine.decode(raw).encode())
                counts[row] += end - start
        for machine, digest in zip(machines, of_text):
            if machine:
                digest.update(machine.decode(b"", True).encode())
        return {
            "doc_id": batch.column("doc_id"),
            "n_tokens": counts,
            "ids_sha256": [d.hexdigest() for d in of_ids],
            "decoded_sha256": [d.hexdigest() for d in of_text],
        }

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), content().alias("text"))
    return in_batches(picked, rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, ranks: bytes, pattern: str, into: str = "token_ids") -> DataFrame:
    """All columns of `docs` and the token ids of `text`."""
    from pyspark.sql.types import StructField, StructType, ArrayType, IntegerType
    from pyspark.sql.pandas.types import to_arrow_schema

    if into in docs.columns:
        raise ValueError(f"column {into} exists already")
    schema = StructType([*docs.schema.fields, StructField(into, ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, arrow = codec(ranks, pattern), to_arrow_schema(schema)
        for batch in batches:
            ids = own.encode_all(list(_texts(batch)))
            made = [*batch.columns, pa.array(ids, type=arrow.field(into).type)]
            yield pa.RecordBatch.from_arrays(
                [a.cast(f.type) for a, f in zip(made, arrow)], schema=arrow
            )

    return docs.mapInArrow(run, schema)


def decode(tokens: DataFrame, ranks: bytes, pattern: str, ids: str = "token_ids") -> DataFrame:
    """All columns but `ids`, and the `text` that the ids stand for."""
    from pyspark.sql.types import StringType, StructField, StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = [f for f in tokens.schema.fields if f.name not in (ids, "text")]
    schema = StructType([*kept, StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, arrow = codec(ranks, pattern), to_arrow_schema(schema)
        for batch in batches:
            texts = ["".join(own.decode([x or []])) for x in batch.column(ids).to_pylist()]
            made = [*(batch.column(f.name) for f in kept), pa.array(texts, type=pa.string())]
            yield pa.RecordBatch.from_arrays(
                [a.cast(f.type) for a, f in zip(made, arrow)], schema=arrow
            )

    return tokens.mapInArrow(run, schema)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return of_documents(table(spark, sf_dir, "documents"))


def of_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Digests with the production vocabulary; `vocabulary` is the path of a rank file."""
    import public_tokenizers

    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    return digests(docs, read_ranks(path), public_tokenizers.PATTERN)


QUERIES = {"op7_byte_bpe": op7_byte_bpe}
SQL: dict[str, str] = {}
