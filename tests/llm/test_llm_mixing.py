import collections
import random

import pytest

import brute
from voltrail.llm import mixing


def documents():
    rng = random.Random(8)
    rows = []
    for i in range(900):
        source = rng.choice(["src0", "src0", "src0", "src1", "src10", "src2", "É", None, "tiny" if i % 97 == 0 else "src3"])
        rows.append((i, source, " ".join("w" for _ in range(rng.randint(0, 60)))))
    return rows


@pytest.mark.parametrize("bins", [mixing.BINS, 4])
def test_query(folder, spark, monkeypatch, bins):
    monkeypatch.setattr(mixing, "BINS", bins)
    docs = documents()
    sf = folder("documents", docs, "doc_id long, source string, text string", ("size", "bin", "target"))
    rows = mixing.op8_mixing(spark, sf).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.op8_mixing(spark, sf).collect()))
    got = {r["doc_id"]: r for r in rows}
    sizes, source_of = collections.Counter(), {}
    for i, source, text in docs:
        size = len(brute.words(text))
        assert got[i]["size"] == size and got[i]["taken"] in (0, size, 2 * size)
        sizes[source] += size
        source_of[i] = source
    want, taken = brute.targets(sizes), collections.Counter()
    for i, r in got.items():
        assert r["source_size"] == sizes[source_of[i]]
        assert r["target"] == pytest.approx(want[source_of[i]])
        taken[source_of[i]] += r["taken"]
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 60


def test_order_is_that_of_a_full_sort(spark):
    df = spark.createDataFrame(documents(), "doc_id long, source string, text string")
    mixed = mixing.mix(df).collect()
    keys = {r["doc_id"]: r["key"] for r in mixing.drawn(df, mixing.quality_weight(), 8).collect()}
    by_source = collections.defaultdict(list)
    for r in mixed:
        by_source[r["source"]].append(r)
    for rows in by_source.values():
        rows.sort(key=lambda r: keys[r["doc_id"]])
        copies = [r["copies"] for r in rows if r["size"]]
        assert copies == sorted(copies, reverse=True) and max(copies) - min(copies) <= 1


def test_heavier_documents_come_first(spark):
    from pyspark.sql import functions as F

    df = spark.range(4000).selectExpr("id AS doc_id", "if(id % 40 < 20, 'a', 'b') AS source", "'w w w' AS text")
    mixed = mixing.mix(df, weights=(1,), share=0.5, weight=F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0))
    taken = mixed.groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("copies").alias("n")).collect()
    n = {r["odd"]: r["n"] for r in taken}
    assert n[0] > 1.4 * n[1]


def test_copies_become_rows(spark):
    docs = [*documents(), *documents()[:40], *documents()[:40]]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumnRenamed("lang", "copies")
    mixed = mixing.mix(df)
    rows = mixing.apply(df, mixed)
    assert rows.columns == df.columns
    want, got = collections.Counter(), collections.Counter(r["doc_id"] for r in rows.collect())
    for r in mixed.collect():
        want[r["doc_id"]] += r["copies"]
    assert got == +want


def test_water_level(spark):
    rng = random.Random(5)
    for _ in range(6):
        sizes = {f"s{i}": rng.choice([0, 1, 5, 50, 500, 5000]) for i in range(rng.randint(1, 9))}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df, (5, 2, 1), 1.5, 2.0).collect()}
        assert got == pytest.approx(brute.targets(sizes))
