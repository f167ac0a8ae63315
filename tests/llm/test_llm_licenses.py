import random
import re

import pytest

import brute
from brute import rows_by_id
from conftest_rows import CLASHING, DOCUMENTS, odd_documents
from voltrail.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(brute.lower(text or ""))


def base(text):
    """(start, label) of each phrase."""
    found, w = [], words(text)
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        found += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return sorted(found)


def met(text, texts=licenses.TEMPLATES, contained=licenses.CONTAINED):
    """Labels and best share, from every block and template compared whole."""
    w, labels, best = words(text), set(), 0.0
    for label, template in texts:
        t = words(template)
        span = 1
        while span < len(t):
            span *= 2
        for at in range(0, max(1, len(w)), span):
            block = set(w[at : at + 2 * span])
            share = len(block & set(t)) / len(set(t))
            if share >= contained - 1e-12:
                labels.add(label)
                best = max(best, share)
    return labels, best


def check(got, docs):
    got = rows_by_id(got)
    assert len(got) == len(docs)
    for i, text in docs:
        r, b = got[i], base(text)
        labels, share = met(text)
        assert r["n_words"] == len(words(text)) and r["n_base"] == len(b)
        assert (r["first_word"], r["last_word"]) == ((b[0][0], b[-1][0]) if b else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in b}))
        assert r["labels"] == ",".join(sorted({x for _, x in b} | labels))
        assert r["score"] == pytest.approx(1.0 if b else share)


def documents():
    rng = random.Random(4)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in words(t)})
    docs = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            if kind < 0.4:
                notice = rng.choice(licenses.TEMPLATES)[1].split()
                for _ in range(rng.randint(0, max(1, len(notice) // 6))):  # damaged notices
                    del notice[rng.randrange(len(notice))]
                parts.append(rng.choice(["# ", "\n * ", " "]).join(notice))
            elif kind < 0.7:  # many template words in no order
                parts.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 300))))
            else:
                parts.append(" ".join(rng.choice(["lorem", "the", "É", "MIT", "LICENSE-", "x1"]) for _ in range(40)))
        docs.append((i, rng.choice(["\n", " ", "\n\n"]).join(parts)))
    return [
        *docs,
        (500, None),
        (501, ""),
        (502, "-- !! \n"),
        (503, "the MIT-License, mit_license; MITLicense; Apache  LICENSE general public license" * 3),
        (504, "İ MIT license K Apache license"),
    ]


def test_query(folder, spark):
    docs = documents()
    sf = folder("documents", docs, "doc_id long, text string", CLASHING)
    check(licenses.op11_license_scan(spark, sf).collect(), docs)


def test_on_the_table(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(licenses.op11_license_scan(spark, sf_dir).collect(), docs)


def test_long_texts_are_cut_between_words(monkeypatch):
    scanner = licenses.Scanner(licenses.templates_of(licenses.TEMPLATES), licenses.PHRASES)
    texts = [t for _, t in documents() if t]
    whole = [scanner.scan(t) for t in texts]
    plain = lambda r: (*r[:5], sorted(map(str, r[5])), sorted((b["span"], b["block"], sorted(b["tokens"])) for b in r[6]))
    for size in (1, 7, 100):
        monkeypatch.setattr(licenses, "PART", size)
        assert [plain(scanner.scan(t)) for t in texts] == [plain(r) for r in whole]


def test_own_templates_and_threshold(spark):
    texts = (("a", "one two three four five six seven eight nine ten"), ("b", "red green blue"))
    docs = [
        (1, "x " * 30 + "one two three four five six seven eight"),
        (2, "one two three four five six seven"),
        (3, "green red"),
        (4, "blue red green " * 50),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = rows_by_id(licenses.scan(df, texts, 0.8, {}).collect())
    assert {i: (r["labels"], r["score"]) for i, r in got.items()} == {1: ("a", 0.8), 2: ("", 0.0), 3: ("", 0.0), 4: ("b", 1.0)}
    for bad in ([("a", "x")] * (licenses.MAX_TEMPLATES + 1), [("a", "--")]):
        with pytest.raises(ValueError):
            licenses.templates_of(bad)


def test_odd_rows(folder, spark):
    rows = odd_documents()
    got = licenses.op11_license_scan(spark, folder("documents", rows, DOCUMENTS, CLASHING)).collect()
    want = sorted((repr(r[0]), len(words(r[1]))) for r in rows)
    assert sorted((repr(r["doc_id"]), r["n_words"]) for r in got) == want
