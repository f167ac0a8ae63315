import random

import brute
from brute import rows_by_id
from voltrail.llm import fingerprints


def some_documents(n=60):
    rng = random.Random(11)
    vocabulary = [f"mot{i}é" if i % 5 == 0 else f"w{'x' * (i % 9)}{i}" for i in range(300)]
    docs = []
    for i in range(n):
        docs.append((3 * i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 80)))))
    docs[10] = (30, docs[4][1])
    return [*docs, (1000, None), (1001, ""), (1003, " \n "), (1002, "𝔘nicode 🙂 text"), (-4, "one")]


def edited(docs):
    order = sorted(docs, reverse=True)
    out = {}
    for (i, text), (j, after) in zip(order, [*order[1:], order[0]]):
        text, after = text or "", after or ""
        half = len(text) // 2
        out[i] = (text[: len(text) - half] + after[:half], after)
    return out


def likeness(a, b):
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / fingerprints.BITS


def test_query(folder, spark):
    docs = some_documents()
    got = rows_by_id(
        fingerprints.op3_document_fingerprints(spark, folder("documents", docs, "doc_id long, text string")).collect()
    )
    want = edited(docs)
    assert len(got) == len(docs)
    for i, text in docs:
        row, (new, after) = got[i], want[i]
        own, other = brute.weighted_simhash(text), brute.weighted_simhash(new)
        assert row["n_chars"] == len(text or "")
        assert row["edited_sha256"] == brute.sha(new)
        assert (row["fingerprint"], row["edited_fingerprint"]) == (own, other)
        assert row["near_edited"] == likeness(own, other)
        assert row["near_next"] == likeness(own, brute.weighted_simhash(after))
    assert got[12]["fingerprint"] == got[30]["fingerprint"]


def test_edits_stay_nearer_than_strangers(spark, sf_dir):
    rows = fingerprints.op3_document_fingerprints(spark, sf_dir).where("n_chars > 400").collect()
    nearer = sum(r["near_edited"] > r["near_next"] for r in rows)
    assert nearer >= 0.95 * len(rows)


def test_order_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keys = spark.range(997).selectExpr(
            "if(id = 0, 0, id * 7) AS id", "id + 1 AS text_key", "id = 0 AS no_id", "id AS n"
        )
        got = {r["id"]: r for r in fingerprints.followers(keys).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 997
    for i in range(1, 996):
        assert got[7 * i]["prev_id"] == 7 * (i + 1) and got[7 * i]["prev_chars"] == i + 1
    assert got[7 * 996]["prev_id"] == 0 and got[0]["prev_id"] == 7


def test_search_within_a_radius(spark):
    rng = random.Random(3)

    def signed(x):
        return x - (1 << 64) if x >= 1 << 63 else x

    words = []
    for _ in range(25):
        word = rng.getrandbits(128)
        words.append(word)
        for bits in (1, 2, 3, 4, 5, 6):
            words.append(word ^ sum(1 << b for b in rng.sample(range(128), bits)))
    rows = [(signed(w & (1 << 64) - 1), signed(w >> 64)) for w in words]
    prints = spark.createDataFrame(rows + rows[:5], "fp0 long, fp1 long")
    for radius in (0, 3, 5):
        found = fingerprints.find_within(prints, prints, radius).collect()
        got = {((r["q0"], r["q1"]), (r["fp0"], r["fp1"]), r["bits"]) for r in found}
        want = {
            (a, b, (x ^ y).bit_count())
            for a, x in zip(rows, words)
            for b, y in zip(rows, words)
            if (x ^ y).bit_count() <= radius
        }
        assert got == want and len(found) == len(want)
