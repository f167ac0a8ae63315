import random

import pytest

import brute
from voltrail.llm import simhash_dedup


def near_documents(n=120):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(n):
        if docs and rng.random() < 0.6:
            text = rng.choice(docs)[1].split(" ")
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            docs.append((i, " ".join(text)))
        else:
            docs.append((i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 40, 300])))))
    return [*docs, (n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, docs[0][1])]


@pytest.mark.parametrize("crowded", [simhash_dedup.CROWDED, 1])
def test_components(spark, crowded, monkeypatch):
    docs = near_documents()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    prints = simhash_dedup.fingerprints(df)
    links = simhash_dedup.near_links
    monkeypatch.setattr(simhash_dedup, "near_links", lambda p, bits: links(p, bits, crowded))
    got = {r["doc_id"]: r for r in simhash_dedup.near_groups(prints, 3).collect()}
    want = [brute.simhash(t) for _, t in docs]
    assert [got[i]["fp"] & (1 << 64) - 1 for i, _ in docs] == want
    assert [got[i]["component_id"] for i, _ in docs] == brute.near_components(want)
    assert len(set(brute.near_components(want))) < len(docs) - 20


def test_links_of_chosen_words(spark):
    """Words at 1 to 5 bits from a few others, all links found on both ways."""
    rng = random.Random(1)
    words = set()
    for _ in range(12):
        word = rng.getrandbits(64)
        words.add(word)
        for bits in (1, 2, 3, 3, 4, 5):
            words.add(word ^ sum(1 << b for b in rng.sample(range(64), bits)))
    words = sorted(words)
    rows = [(simhash_dedup._signed(w),) for w in words]
    points = spark.createDataFrame(rows, "fp long")
    want = {(a, b) for i, (a,) in enumerate(rows) for (b,) in rows[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    got = {tuple(r) for r in simhash_dedup.near_links(points).collect()}
    assert {tuple(sorted(x)) for x in got} == {tuple(sorted(x)) for x in want}


def test_one_of_each_group_stays(spark):
    docs = near_documents()
    docs = [*docs, docs[3], docs[3]]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, fp string")
    groups = simhash_dedup.grouped(df)
    kept = simhash_dedup.apply(df, groups)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids) == sorted({r["component_id"] for r in groups.collect()})


def test_components_without_an_id_of_their_own_stay(spark):
    """Unlike texts with null ids, and two unlike texts under one id."""
    rng = random.Random(11)
    texts = [" ".join(rng.choice(["red", "sea", "tin", "oak", "fog", "hat"]) + str(rng.randrange(99)) for _ in range(60)) for _ in range(8)]
    docs = [(None, t) for t in texts[:5]] + [(None, texts[0]), (7, texts[5]), (7, texts[6]), (3, texts[7]), (None, texts[7])]
    assert len({brute.simhash(t) for t in texts}) == len(set(brute.near_components([brute.simhash(t) for t in texts]))) == 8
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = [tuple(r) for r in simhash_dedup.apply(df, simhash_dedup.grouped(df)).collect()]
    assert sorted(kept, key=repr) == sorted([*docs[:5], *docs[6:9]], key=repr)


def test_long_chain_of_links(spark):
    """Components whose ends are many links apart."""
    from voltrail.llm.components import components

    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000}
