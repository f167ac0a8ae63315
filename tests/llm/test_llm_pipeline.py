"""The pipeline against its stages done by hand, and its decisions."""

import collections

import public_tokenizers
import tiktoken

import brute
import corpus_pipeline
from conftest_rows import CLASHING, DOCUMENTS, odd_documents
from voltrail.llm import bpe, mixing, quality
from voltrail.llm.common import stored


def staged(spark, docs, sf_dir):
    rows = [docs]
    for name, stage in corpus_pipeline.STAGES:
        rows.append(stored(stage(spark, rows[-1], sf_dir), "test-stage"))
    return rows


def test_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = staged(spark, docs, sf_dir)
    for stage in rows[:-1]:
        assert stage.columns == docs.columns
    raw, good, lines, single, mixed = (
        sorted(((r["doc_id"], r["text"]) for r in x.collect()), key=repr) for x in rows[:-1]
    )
    model = quality.train(quality.described(docs))
    assert {i for i, _ in good} == {
        i
        for i, t in raw
        if quality.chance(*_features(t), model) >= quality.THRESHOLD
    }
    assert {i: t or "" for i, t in lines} == {i: w[2] for i, w in brute.line_dedup(good).items()}
    prints = [brute.simhash(t) for _, t in sorted(lines)]
    groups = brute.near_components(prints)
    ids = [i for i, _ in sorted(lines)]
    assert [i for i, _ in sorted(single)] == sorted({ids[g] for g in groups})
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(rows[3]).collect()}
    assert collections.Counter(i for i, _ in mixed) == +collections.Counter(copies)
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.parse_ranks(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))),
        special_tokens={},
    )
    want = collections.Counter((i, len(library.encode_ordinary(t or "")), brute.sha(t or "")) for i, t in mixed)
    got = collections.Counter((r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in rows[-1].collect())
    assert got == want


def _features(text):
    traits = quality.traits((text or "").encode())
    return list(traits.features), list(traits.features.values())


def test_run_gives_what_the_stages_give(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = sorted(map(tuple, staged(spark, docs, sf_dir)[-1].collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == want


def test_odd_rows_and_clashing_columns(folder, spark):
    sf = folder("documents", odd_documents(), DOCUMENTS, CLASHING)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = staged(spark, docs, sf)
    assert all(x.columns == docs.columns for x in rows[:-1])
    sf = folder("documents", [], DOCUMENTS)
    assert corpus_pipeline.run(spark, sf).count() == 0
