import numpy as np
import pytest
from pyspark.sql import functions as F

from voltrail.llm import neighbours


def answers(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def exact(ids, x, query, k=10):
    gaps = np.sqrt(((x - x[ids.index(query)]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, gaps)) if ids[i] != query][:k]
    return [(n + 1, ids[i], gaps[i]) for n, i in enumerate(order)]


def test_recall_on_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids = [r["vec_id"] for r in rows]
    x = np.array([r["embedding"] for r in rows], dtype=float)
    got = answers(neighbours.op4_nearest_neighbours(spark, sf_dir).collect())
    assert set(got) == {i for i in ids if i % 100 == 0}
    hits = 0
    for query, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 11))
        for _, i, score in found:
            assert score == pytest.approx(np.sqrt(((x[ids.index(i)] - x[ids.index(query)]) ** 2).sum()), rel=1e-12)
        hits += len({i for _, i, _ in found} & {i for _, i, _ in exact(ids, x, query)})
    assert hits >= 0.9 * 10 * len(got)


def test_recall_over_many_lists(spark, monkeypatch):
    """Many small lists and packs, a vector that a third of the rows share."""
    monkeypatch.setattr(neighbours, "PER_LIST", 50)
    monkeypatch.setattr(neighbours, "PACK", 40)
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1500, 24)).astype(np.float32).astype(float)
    x[::3] = x[0]
    ids = list(range(1500))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in zip(ids, x)], "vec_id long, embedding array<float>")
    got = answers(neighbours.nearest(df, F.col("vec_id") % 50 == 0).collect())
    hits = 0
    for query, found in got.items():
        want = exact(ids, x, query)
        hits += len({i for _, i, _ in found} & {i for _, i, _ in want})
        if query % 3 == 0:  # ties at distance 0: the smallest ids
            assert found == [(n, i, 0.0) for n, i, _ in want]
    assert len(got) == 30 and hits >= 0.9 * 300


def test_odd_vectors(folder, spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i), 1.0]) for i in range(6)]
    rows += [(100, [0.5, 1.0]), (100, [0.5, 1.0]), (200, None), (300, [0.0, 0.0]), (400, [nan, 1.0]), (7, [inf, 1.0])]
    rows += [(500, [1.0, 2.0, 3.0]), (600, []), (700, [None, 1.0]), (None, [1.0, 1.0])]
    sf = folder("embeddings", rows, "vec_id long, embedding array<float>", ("list", "part", "vector", "rank", "score"))
    got = answers(neighbours.op4_nearest_neighbours(spark, sf).collect())
    ids = [0, 1, 2, 3, 4, 5, 100]
    x = np.array([[0, 1], [1, 1], [2, 1], [3, 1], [4, 1], [5, 1], [0.5, 1]], dtype=float)
    assert got == {q: exact(ids, x, q) for q in (0, 100)}


def test_empty_table(folder, spark):
    df = neighbours.op4_nearest_neighbours(spark, folder("embeddings", [], "vec_id long, embedding array<float>"))
    assert df.columns == ["query_id", "rank", "vec_id", "score"] and df.count() == 0


def test_candidates_are_abandoned_early(spark):
    """Share of the dimensions read and recall, over all queries of a table."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    rows.sort(key=lambda r: r["vec_id"])
    ids = [r["vec_id"] for r in rows]
    x = np.array([r["embedding"] for r in rows], dtype=float)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in zip(ids, x)], "vec_id long, vector array<double>")
    index = neighbours.fit(df)
    reader = neighbours.Reader(index, 10)
    turned, hits, queries = x @ index.rotation, 0, 0
    home, rest = x[: len(x) // 2], x[len(x) // 2 :]
    for at in range(0, len(x), 37):
        skip = np.arange(len(x)) == at
        cut = len(home)
        a, gaps = reader.scan(x[at], turned[at], home, turned[:cut], skip[:cut])
        b, more = reader.scan(x[at], turned[at], rest, turned[cut:], skip[cut:], np.sort(gaps)[9])
        found = sorted(zip([*gaps, *more], [*a, *(b + cut)]))[:10]
        hits += len({ids[i] for _, i in found} & {i for _, i, _ in exact(ids, x, ids[at])})
        queries += 1
    share = reader.read / (queries * len(x) * x.shape[1])
    print(f"{share:.3f} of the dimensions read, recall {hits / queries / 10:.3f}, slack {index.slack:.2f}")
    assert share <= 0.63 and hits >= 0.95 * 10 * queries


def test_bounds_and_ties():
    """Candidates as far as the bound stay; a bound below all leaves none."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 16))
    x[100:120] = x[5]
    index = neighbours.Index(np.linalg.qr(rng.standard_normal((16, 16)))[0], x[:1], 1, 3.0)
    reader = neighbours.Reader(index, 10)
    none = np.zeros(300, dtype=bool)
    at, gaps = reader.scan(x[5], x[5] @ index.rotation, x, x @ index.rotation, none, 0.0)
    assert sorted(at) == [5, *range(100, 120)] and (gaps == 0).all()
    far = x[5] + 100
    at, _ = reader.scan(far, far @ index.rotation, x, x @ index.rotation, none, 1.0)
    assert len(at) == 0
