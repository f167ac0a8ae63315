"""SimHash document fingerprints and search within a Hamming radius, DataFrame only.

A term is a word with the word behind it (the last word stands alone). Its two 64-bit
hashes vote on 128 signed bits with a weight that grows with the word's length, so
little words count less. Sums of votes are kept two to a long (32 bits each), one
grouping by document adds them up before any shuffle, and a bit is set where the votes
for it are more than half of all.

`find_within` answers radius queries with permuted block tables: the bits are cut into
blocks, each table holds the fingerprints under some of the blocks, and any two within
the radius agree in all blocks of at least one table.

Defined results: null, empty and wordless texts have the fingerprint of all zeros;
equal texts have equal fingerprints; repeated rows (same doc_id and text) are one
document with a row each; a null doc_id comes after all others; rows of one doc_id
with different texts follow each other by a hash of the text; an only document is its
own next one; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltrail.llm.common import SPACES, SPACE_CLASS, content, stored, table

#: 64-bit words of a fingerprint, and the seeds of their hashes.
SEEDS = (1, 2)
BITS = 64 * len(SEEDS)
_LANES = 0x0000000100000001
_LOW = 0xFFFFFFFF
WORDS = tuple(f"fp{i}" for i in range(len(SEEDS)))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, and a key without nulls (id, text_key) that tells documents apart."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(doc_id, F.lit(0)).alias("id"),
        F.xxhash64(doc_id.isNull(), content()).alias("text_key"),
        content().alias("text"),
    )


def fingerprinted(rows: DataFrame, text: str, *, by: list[str], prefix: str = "") -> DataFrame:
    """`by` columns and the fingerprint words of `text`; one row per group of `by`."""
    trimmed = F.btrim(F.col(text), F.lit(SPACES))
    words = F.split(trimmed, SPACE_CLASS + "+")
    split = rows.select(*by, words.alias("__words"))
    pairs = F.arrays_zip(
        F.col("__words").alias("a"), F.slice("__words", 2, F.greatest(F.size("__words"), F.lit(1))).alias("b")
    )
    each = split.select(*by, F.explode(pairs).alias("t")).select(*by, F.col("t.a").alias("a"), F.col("t.b").alias("b"))
    each = each.select(
        *by,
        # Splitting the empty text gives one empty word: it has no vote.
        F.when(F.col("a") == "", F.lit(0)).otherwise(F.least(F.lit(4), 1 + F.shiftright(F.octet_length("a"), 2))).cast("long").alias("w"),
        *[F.xxhash64(F.lit(s), "a", "b").alias(f"h{s}") for s in SEEDS],
    )
    lane = F.lit(_LANES)
    votes = [
        F.sum(F.shiftrightunsigned(f"h{s}", k).bitwiseAND(lane) * F.col("w")).alias(f"v{s}_{k}")
        for s in SEEDS
        for k in range(32)
    ]
    summed = each.groupBy(*by).agg(F.sum("w").alias("all"), *votes)

    def bit(seed: int, k: int) -> Column:
        low, at = k % 32, k // 32
        lanes = F.col(f"v{seed}_{low}")
        count = F.shiftrightunsigned(lanes, 32) if at else lanes.bitwiseAND(F.lit(_LOW))
        one = F.lit(1 << k if k < 63 else -(1 << 63))
        return F.when(count * 2 > F.col("all"), one).otherwise(F.lit(0).cast("long"))

    def word(seed: int) -> Column:
        return reduce(lambda a, b: a.bitwiseOR(b), [bit(seed, k) for k in range(64)])

    return summed.select(*by, *[word(s).alias(prefix + w) for s, w in zip(SEEDS, WORDS)])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp0, fp1 of every row."""
    rows = keyed(docs)
    prints = fingerprinted(rows, "text", by=["id", "text_key"])
    return rows.drop("text").join(prints, ["id", "text_key"]).select("doc_id", *WORDS)


def distance(a: list[Column], b: list[Column]) -> Column:
    return reduce(lambda x, y: x + y, [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)])


def hexadecimal(words: list[Column]) -> Column:
    return F.concat(*[F.lower(F.lpad(F.hex(w), 16, "0")) for w in words])


def block_tables(radius: int, kept: int = 2) -> list[tuple[int, ...]]:
    """Masks, per fingerprint word, of `kept` of `radius + kept` blocks of bits."""
    count = radius + kept
    edges = [BITS * i // count for i in range(count + 1)]
    blocks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(count)]

    def signed(x: int) -> int:
        return x - (1 << 64) if x >= 1 << 63 else x

    masks = [sum(c) for c in combinations(blocks, kept)]
    return [tuple(signed(m >> (64 * i) & (1 << 64) - 1) for i in range(len(SEEDS))) for m in masks]


def find_within(queries: DataFrame, prints: DataFrame, radius: int = 3) -> DataFrame:
    """All fingerprints within `radius` bits of each query: the query's words as q0, q1,
    the found words, and the bits in which they differ. Both sides count each
    fingerprint once; join members back by the words."""
    masks = block_tables(radius)

    def tabled(rows: DataFrame, names: list[str]) -> DataFrame:
        words = [F.col(w) for w in WORDS]
        cells = [F.struct(*[w.bitwiseAND(F.lit(m)) for w, m in zip(words, mask)]) for mask in masks]
        return (
            rows.select(*WORDS)
            .distinct()
            .select(*[w.alias(n) for w, n in zip(words, names)], F.posexplode(F.array(*cells)).alias("tab", "cell"))
        )

    asked = [f"q{i}" for i in range(len(SEEDS))]
    a = tabled(queries, asked).alias("a")
    b = tabled(prints, list(WORDS)).alias("b")
    differ = distance([F.col(f"a.{q}") for q in asked], [F.col(f"b.{w}") for w in WORDS])
    found = a.join(
        b, (F.col("a.tab") == F.col("b.tab")) & (F.col("a.cell") == F.col("b.cell")) & (differ <= radius)
    )
    return found.select(
        *[F.col(f"a.{q}") for q in asked], *[F.col(f"b.{w}") for w in WORDS], differ.alias("bits")
    ).distinct()


def followers(keys: DataFrame) -> DataFrame:
    """id, text_key of every document, and prev_id, prev_key, prev_chars of the one it
    comes next to, by descending doc_id; the first one follows the last.

    Only keys are sorted: a range partitioning, the order inside each range, and one
    row per range for the places where two ranges meet.
    """
    order = [F.col("no_id").asc(), F.col("id").desc(), F.col("text_key").asc()]
    ranged = stored(
        keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "document-order"
    )
    inside = Window.partitionBy("part").orderBy(*order)
    before = F.lag(F.struct("id", "text_key", "n")).over(inside)
    lasts = ranged.groupBy("part").agg(
        F.max_by(F.struct("id", "text_key", "n"), F.struct("no_id", -F.col("id"), "text_key")).alias("last")
    )
    # One row per range.
    ends = lasts.select(
        F.col("part").alias("at"),
        F.coalesce(
            F.lag("last").over(Window.orderBy("part")),
            F.first("last").over(Window.orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, 0)),
        ).alias("ahead"),
    )
    placed = ranged.withColumn("before", before)
    placed = placed.join(ends, F.col("part") == F.col("at"), "left")
    prev = F.coalesce("before", "ahead")
    return placed.select(
        "id",
        "text_key",
        prev["id"].alias("prev_id"),
        prev["text_key"].alias("prev_key"),
        prev["n"].alias("prev_chars"),
    )


def edited(docs: DataFrame) -> DataFrame:
    """Per document: its edited text and the fingerprints of the text and of the next
    document's. The second half of the text gives way to the next one's beginning.

    What is known of a document beside its text is small and stored. Whole texts are
    shuffled once, by (id, text_key); the second use of them reuses that exchange and
    sends only the beginnings that the documents before them need.
    """
    key = ["id", "text_key"]
    rows = keyed(docs)
    known = rows.select(
        *key, F.col("doc_id").isNull().alias("no_id"), F.char_length("text").cast("long").alias("n")
    )
    known = stored(known.groupBy(*key, "no_id", "n").agg(F.count("*").alias("copies")), "document-keys")
    follows = followers(known.select(*key, "no_id", "n"))
    # A repeated row votes as often in all: the same bits win.
    prints = fingerprinted(rows, "text", by=key)
    known = stored(known.join(follows, key).join(prints, key), "document-facts")
    texts = rows.select(*key, "text").join(known, key)
    first = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    once = texts.withColumn("at", first).where("at = 1")
    beginnings = once.select(
        F.col("prev_id").alias("id"),
        F.col("prev_key").alias("text_key"),
        F.left("text", F.floor(F.col("prev_chars") / 2).cast("int")).alias("beginning"),
        *[F.col(w).alias(f"next_{w}") for w in WORDS],
    )
    head = F.left("text", (F.col("n") - F.floor(F.col("n") / 2)).cast("int"))
    own = once.select(
        *key,
        F.when(~F.col("no_id"), F.col("id")).alias("doc_id"),
        "copies",
        F.col("n").alias("n_chars"),
        head.alias("head"),
        *WORDS,
    )
    return own.join(beginnings, key).select(
        *key,
        "doc_id",
        "copies",
        "n_chars",
        F.concat("head", "beginning").alias("edited_text"),
        *WORDS,
        *[f"next_{w}" for w in WORDS],
    )


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edited(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.encode("edited_text", "UTF-8"), 256))
    by = [c for c in rows.columns if c != "edited_text"]
    prints = fingerprinted(rows, "edited_text", by=by, prefix="edited_")
    own = [F.col(w) for w in WORDS]
    new = [F.col(f"edited_{w}") for w in WORDS]
    following = [F.col(f"next_{w}") for w in WORDS]
    result = prints.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hexadecimal(own).alias("fingerprint"),
        hexadecimal(new).alias("edited_fingerprint"),
        (1 - distance(own, new) / BITS).alias("near_edited"),
        (1 - distance(own, following) / BITS).alias("near_next"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    )
    return result.drop("copy")


QUERIES = {"op3_document_fingerprints": op3_document_fingerprints}
SQL: dict[str, str] = {}
