import hashlib
import itertools
import random
import re
import zlib

import pytest

from conftest_rows import CLASHING
from voltrail.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")
SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    """Rows after damage by conversation, in reading order."""
    out = {}
    shown = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        kept += [(turn, role, text)] * (2 if hit == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        ended = text.rstrip(SPACES)
        blank = not ended
        again = (role, text) in seen
        seen.add((role, text))
        out.append("blank" if blank else "duplicate" if again else "truncated" if ended[-1] not in ".!?" else "")
    return out


def cheapest(initials, found):
    """(cost, audit) by plain dynamic programming over (cost, letters) pairs."""
    best = {"": (0, "")}  # what the roles end in so far: "", s, u, a

    def inserted(best):
        for _ in range(4):
            for end, (cost, audit) in list(best.items()):
                new = "a" if end == "u" else "u"
                best[new] = min(best.get(new, (1 << 60, "")), (cost + 2, audit + "I"))
        return best

    best = inserted(best)
    for initial, fault in zip(initials, found):
        after = {}
        for end, (cost, audit) in best.items():
            ways = [(end, 3, "D")]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                new = "a" if end == "u" else "u"
                ways.append((new, 2 + more, "R"))
                if initial == new or (initial == "s" and end == ""):
                    ways.append((initial, more, "K"))
            for new, price, letter in ways:
                after[new] = min(after.get(new, (1 << 60, "")), (cost + price, audit + letter))
        best = inserted(after)
    return min(best[e] for e in ("", "a") if e in best)


def by_enumeration(initials, found):
    """The same from every list of edits with up to two insertions at each place."""
    best = (1 << 60, "")
    options = []
    for initial, fault in zip(initials, found):
        more = fault == "truncated"
        ways = [("D", "", 3)]
        if fault not in ("blank", "duplicate"):
            ways += [("K", initial or "?", more), ("R", "u", 2 + more), ("R", "a", 2 + more)]
        options.append(ways)
    gaps = [("", ""), ("I", "u"), ("I", "a"), ("II", "ua"), ("II", "au")]
    for edits in itertools.product(*options):
        for put in itertools.product(gaps, repeat=len(edits) + 1):
            roles = put[0][1] + "".join(e[1] + p[1] for e, p in zip(edits, put[1:]))
            if LEGAL.fullmatch(roles):
                audit = put[0][0] + "".join(e[0] + p[0] for e, p in zip(edits, put[1:]))
                best = min(best, (sum(e[2] for e in edits) + 2 * audit.count("I"), audit))
    return best


def expected(rows):
    out = {}
    for conv, kept in damaged(rows).items():
        found = faults(kept)
        initials = [r[1][:1] for r in kept]
        cost, audit = cheapest(initials, found)
        lines, at, end = [], 0, ""
        for letter in audit:
            row = kept[at] if letter != "I" else None
            at += letter != "I"
            if letter == "D":
                continue
            if letter == "K":
                end = row[1][:1]
                lines.append(f"{row[1]}:{row[2]}")
            else:
                end = "a" if end == "u" else "u"
                lines.append(("user:" if end == "u" else "assistant:") + (row[2] if row else ""))
        turns = [r[0] for r in kept if r[0] is not None]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(found.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def got(df):
    found = df.collect()
    out = {r["conv_id"]: tuple(r)[1:9] for r in found}
    assert len(out) == len(found)
    return out


def conversations():
    rng = random.Random(6)
    texts = ["Hi.", "Hi", "", " \t\n", "Why?", "Yes!  \n", "no", "é.", "Hi.", None, "a. b", "…"]
    roles = ["user"] * 6 + ["assistant"] * 6 + ["system", "system", "User", "tool", "", None, "a"]
    rows = []
    for conv in range(400):
        for turn in range(rng.randint(0, 9)):
            rows.append((conv, turn + rng.choice([0, 0, 0, 3]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"t{rng.random()}."))
    for conv in (1000, None):  # ties, repeated rows, no turns
        rows += [(conv, rng.choice([None, None, 2, 3]), rng.choice(roles), rng.choice(texts)) for _ in range(60)]
    rows += [(1001, 7, "user", "x" * 300_000), (1001, 8, "assistant", "y. " * 100_000)]
    for conv in (1002, 1003, 1004):  # long ones
        rows += [(conv, t, rng.choice(roles[:14]), rng.choice(texts) if rng.random() < 0.2 else f"{t}.") for t in range(700)]
    return rows


def test_query(folder, spark):
    rows = conversations()
    want = expected(rows)
    assert any(not w[6] and not any(w[:6]) for w in want.values())  # all rows dropped
    assert got(repair.op13_conversation_repair(spark, folder("conversations", rows, SCHEMA, CLASHING))) == want


def test_on_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(repair.op13_conversation_repair(spark, sf_dir)) == expected(rows)


def test_empty_table(folder, spark):
    assert repair.op13_conversation_repair(spark, folder("conversations", [], SCHEMA)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_cheapest_by_enumeration(n):
    kinds = list(itertools.product("suax", ("", "truncated", "blank")))
    for rows in itertools.product(kinds, repeat=n) if n < 3 else random.Random(1).sample(list(itertools.product(kinds, repeat=3)), 150):
        initials, found = [r[0] for r in rows], [r[1] for r in rows]
        want = by_enumeration(initials, found)
        assert cheapest(initials, found) == want
        paths = repair.Paths()
        for i, f in rows:
            paths.push(i, f == "blank", f == "truncated")
        assert paths.finish() == want


@pytest.mark.parametrize("window", [8, 96])
def test_letters_settle_on_the_way(window):
    """Long random rows: letters given out early are those of the cheapest audit."""
    rng = random.Random(window)
    for weights in ((1, 4, 4, 0), (1, 9, 1, 1), (9, 1, 1, 1), (0, 1, 0, 0), (0, 0, 0, 1), (1, 1, 1, 1)):
        initials = rng.choices("suax", weights, k=1500)
        found = rng.choices(["", "truncated", "blank"], (8, 1, 1), k=1500)
        paths, letters = repair.Paths(window), ""
        for i, (initial, fault) in enumerate(zip(initials, found)):
            paths.push(initial, fault == "blank", fault == "truncated")
            if i % 40 == 39:
                letters += paths.settled()
        cost, rest = paths.finish()
        assert (cost, letters + rest) == cheapest(initials, found)


def test_an_orderly_conversation_keeps_the_integers_short():
    now = repair.Judged(1)
    for t in range(20_000):
        now.row((t, "user" if t % 2 else "assistant", str(t).encode()), False, t % 7 == 0)
    assert now.paths.window <= 512
    assert len(now.result()[-1]) >= 20_000


def test_turns_with_equal_rows_in_several_conversations(spark):
    rows = [(c, t, "user", "same.", 1) for c in (1, 2) for t in (1, 1, 2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies int")
    found = {r["conv_id"]: (r["duplicate"], r["illegal"], r["audit"]) for r in repair.repair(df).collect()}
    assert found == {1: (2, 2, "KDDI"), 2: (2, 2, "KDDI")}
