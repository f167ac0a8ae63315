"""Archives built from `documents` and `pages`: listing, reading, checking, landing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.telemetry_view import table
from voltrail.functions.columns import base_name, resolved_member_path
from voltrail.operators.pack import pack, split_volumes, volume_name, write_files, write_volumes
from voltrail.session import new_workdir
from voltrail.sources import archives, zip_directory

# Documents of one source and one block of ids share an archive of bounded size.
BLOCK = 256
VOLUME = 256 << 20

_ARCHIVE = f"concat(source, '-', cast(doc_id div {BLOCK} AS string))"
_MEMBER = "concat(lang, '/doc-', cast(doc_id AS string), '.txt')"


def written_archives(
    spark: SparkSession,
    sf_dir: str,
    member: str = _MEMBER,
    method: str = "DEFLATE",
    content: Column | None = None,
    below: str = "",
) -> str:
    """Packs the documents and writes the ZIP files; returns their folder."""
    folder = new_workdir(spark, "raw") + below
    packed = pack(
        table(spark, sf_dir, "documents"),
        F.expr(_ARCHIVE),
        F.expr(member),
        F.col("text"),
        ["doc_id"],
        method=method,
        volume_bytes=VOLUME,
    )
    target = F.concat(F.lit(folder + "/"), volume_name())
    content = F.col("content") if content is None else content
    write_files(packed, target, content).write.format("noop").mode("overwrite").save()
    return folder


def archive_key(path: Column) -> Column:
    """The archive name without folder, shard and volume."""
    return F.regexp_replace(base_name(path), "-\\d{5}-\\d{5}\\.zip$", "")


def _listed(spark: SparkSession, sf_dir: str, **kwargs) -> DataFrame:
    folder = written_archives(spark, sf_dir, **kwargs)
    return archives.list_members(archives.read_archives(spark, folder, "*.zip"))


def _doc_id() -> Column:
    return F.regexp_extract("member", "doc-(\\d+)\\.txt$", 1).cast("bigint").alias("doc_id")


def _texts(members: DataFrame) -> DataFrame:
    failed = F.concat(F.lit("member not read: "), "read_error")
    data = F.when(F.col("read_error").isNull(), F.col("data")).otherwise(F.raise_error(failed).cast("binary"))
    return archives.read_whole(members).select(_doc_id(), data.cast("string").alias("text"))


def archive_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir).select(
        archive_key(F.col("path")).alias("archive"),
        "position",
        "member",
        "method",
        "uncompressed_size",
        "is_directory",
    )


def archive_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = written_archives(spark, sf_dir)
    listed = archives.inventory(archives.read_archives(spark, folder))
    return archives.summarize(listed).select(
        archive_key(F.col("path")).alias("archive"),
        "kind",
        "methods",
        "solid",
        "blocks",
        "members",
        "total_uncompressed",
    )


def archive_extract_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(_listed(spark, sf_dir))


def archive_extract_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _listed(spark, sf_dir)
    return _texts(
        archives.select_members(listed, names=["en/doc-0.txt", "en/doc-1.txt"], prefixes=["fr/", "es/"])
    )


def archive_extract_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members named by a table: those of the labelled documents."""
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct()
    names = (
        table(spark, sf_dir, "documents")
        .join(labelled, "doc_id", "left_semi")
        .select(F.expr(_MEMBER).alias("member"))
    )
    return _texts(archives.select_members(_listed(spark, sf_dir), names=names))


def archive_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the sources has a changed byte, another third lost its second half."""
    state = F.regexp_extract("archive", "^src(\\d+)-", 1).cast("int") % 3
    name_size = F.conv(F.hex(F.expr("substring(content, 27, 1)")), 16, 10).cast("int")
    data_at = name_size + 31
    changed = F.concat(
        F.substring(F.col("content"), F.lit(1), data_at - 1),
        F.unhex(F.lit("00")),
        F.substring(F.col("content"), data_at + 1, F.length("content")),
    )
    cut = F.substring(F.col("content"), F.lit(1), F.floor(F.length("content") / 2).cast("int"))
    content = F.when(state == 1, changed).when(state == 2, cut).otherwise(F.col("content"))
    folder = written_archives(spark, sf_dir, method="COPY", content=content)
    listed = archives.inventory(archives.read_archives(spark, folder))
    return archives.integrity(listed).select(
        archive_key(F.col("path")).alias("archive"), "status", "first_bad", "members_read"
    )


# Leading bytes put before each page, by page number modulo 8.
_HEADS = ("377ABCAF271C", "FD377A585A00", "504B0304", "28B52FFD", "50415231", "425A68", "1F8B", "")


def archive_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_workdir(spark, "mixed")
    head = F.element_at(F.array(*[F.lit(h) for h in _HEADS]), (F.col("page_id") % 8 + 1).cast("int"))
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit(folder + "/page-"), F.col("page_id")).alias("target"),
        F.concat(F.unhex(head), F.encode("html", "UTF-8")).alias("content"),
    )
    write_files(pages, F.col("target"), F.col("content")).write.format("noop").mode("overwrite").save()
    kinds = archives.sniff(archives.read_archives(spark, folder))
    return kinds.select(
        F.regexp_extract("path", "page-(\\d+)$", 1).cast("bigint").alias("page_id"), "kind", "length"
    )


_TARGET = "/landing/out"


def member_path_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        """concat(element_at(array('data/', '/abs/', '../', 'a/../', './b/', 'a/../../', '../out/', 'c//d/./'),
           cast(page_id % 8 + 1 AS int)), cast(page_id AS string), '.html') AS member""",
    )
    resolved = pages.withColumn("resolved", resolved_member_path(F.col("member"), _TARGET))
    return resolved.withColumn(
        "status", F.when(F.col("resolved").isNull(), "rejected").otherwise("safe")
    )


def duplicate_member_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = _listed(spark, sf_dir, member="concat(lang, '.txt')")
    return archives.with_output_names(listed).select(
        archive_key(F.col("path")).alias("archive"), "position", "output_name"
    )


def landing_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members land under their base name; of equal names the last one stays."""
    clashing = "concat(lang, '/pair-', cast(doc_id div 2 AS string), '.txt')"
    # Files of one run are taken as having arrived at one time.
    listed = _listed(spark, sf_dir, member=clashing).withColumn(
        "archive_modified", F.lit("2024-01-01 00:00:00").cast("timestamp")
    )
    target = new_workdir(spark, "processed")
    winners = archives.last_by_base_name(listed).withColumn(
        "target", F.concat(F.lit(target + "/"), F.col("base_name"))
    )
    archives.land_members(winners).write.format("noop").mode("overwrite").save()
    return (
        spark.read.format("binaryFile")
        .load(target)
        .select(base_name(F.col("path")).alias("name"), F.col("content").cast("string").alias("text"))
    )


def archive_pack_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages under one archive name, so that name has to be split over tasks."""
    folder = new_workdir(spark, "packed")
    packed = pack(
        table(spark, sf_dir, "pages"),
        F.lit("pages"),
        F.concat(F.col("page_id"), F.lit(".html")),
        F.col("html"),
        ["page_id"],
        volume_bytes=1 << 20,
        shard_bytes=2 << 20,
    )
    target = F.concat(F.lit(folder + "/"), volume_name())
    write_files(packed, target, F.col("content")).write.format("noop").mode("overwrite").save()
    members = archives.list_members(archives.read_archives(spark, folder))
    return archives.read_whole(members).select(
        F.regexp_extract("member", "^(\\d+)", 1).cast("bigint").alias("page_id"),
        F.col("data").cast("string").alias("html"),
    )


def archive_volumes_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives cut into volumes of fixed size and read from them."""
    folder = new_workdir(spark, "volumes")
    packed = pack(
        table(spark, sf_dir, "documents"),
        F.expr(_ARCHIVE),
        F.expr(_MEMBER),
        F.col("text"),
        ["doc_id"],
        volume_bytes=VOLUME,
    )
    files = packed.select(F.concat(F.lit(folder + "/"), volume_name()).alias("target"), "content")
    volumes = split_volumes(files, 20_000)
    write_files(volumes, F.col("target"), F.col("content")).write.format("noop").mode("overwrite").save()
    found = archives.join_volumes(archives.read_archives(spark, folder))
    return _texts(archives.list_members(found))


CHUNK = 1_000


def archive_streamed_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in chunks, streamed to ZIP files in volumes, and read from the volumes."""
    folder = new_workdir(spark, "volumes")
    text = F.encode(F.col("text"), "utf-8")
    count = F.greatest(F.ceil(F.length(text) / CHUNK), F.lit(1)).cast("int")
    chunks = table(spark, sf_dir, "documents").select(
        "*", F.explode(F.sequence(F.lit(0), count - 1)).alias("chunk")
    )
    written = write_volumes(
        chunks,
        F.concat(F.lit(folder + "/"), F.expr(_ARCHIVE), F.lit(".zip")),
        F.expr(_MEMBER),
        F.substring(text, F.col("chunk") * CHUNK + 1, F.lit(CHUNK)),
        ["doc_id"],
        "chunk",
        volume_bytes=30_000,
    )
    written.write.format("noop").mode("overwrite").save()
    found = archives.join_volumes(archives.read_archives(spark, folder))
    return _texts(archives.list_members(found))


def archive_listing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of long names whose directory is read by ranges."""
    folder = new_workdir(spark, "raw")
    written = write_volumes(
        table(spark, sf_dir, "documents"),
        F.concat(F.lit(folder + "/"), F.expr("doc_id div 2000"), F.lit(".zip")),
        F.concat(F.lit("folder-" * 60), F.expr(_MEMBER)),
        F.col("text"),
        ["doc_id"],
        volume_bytes=VOLUME,
    )
    written.write.format("noop").mode("overwrite").save()
    found = archives.join_volumes(archives.read_archives(spark, folder))
    listed = archives.members_of(archives.inventory(found, directory_bytes=zip_directory.RECORD_MOST))
    return listed.select(_doc_id(), "position", "occurrence", F.col("uncompressed_size").alias("size"))


def single_member_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as compressed JSON lines, opened again as archives."""
    customer = table(spark, sf_dir, "customer")
    folder = new_workdir(spark, "compressed")
    for codec in ("gzip", "bzip2"):
        (
            customer.write.option("compression", codec)
            .option("maxRecordsPerFile", 10_000)
            .json(f"{folder}/{codec}")
        )
    listed = archives.list_members(archives.read_archives(spark, folder, "part-*"), measure=False)
    lines = archives.read_whole(listed).select(
        "kind", F.explode(F.split(F.col("data").cast("string"), "\n")).alias("line")
    )
    parsed = F.from_json("line", customer.schema).alias("c")
    return lines.where(F.col("line") != "").select("kind", parsed).select("kind", "c.*")


QUERIES = {
    "archive_listing": archive_listing,
    "archive_summary": archive_summary,
    "archive_extract_all": archive_extract_all,
    "archive_extract_prefix": archive_extract_prefix,
    "archive_extract_named": archive_extract_named,
    "archive_integrity": archive_integrity,
    "archive_sniff": archive_sniff,
    "member_path_check": member_path_check,
    "duplicate_member_names": duplicate_member_names,
    "landing_last_wins": landing_last_wins,
    "archive_pack_roundtrip": archive_pack_roundtrip,
    "archive_volumes_roundtrip": archive_volumes_roundtrip,
    "archive_streamed_volumes": archive_streamed_volumes,
    "archive_listing_ranges": archive_listing_ranges,
    "single_member_containers": single_member_containers,
}

_DOCS = f"""WITH docs AS (
  SELECT *, source || '-' || CAST(doc_id // {BLOCK} AS VARCHAR) AS archive,
         lang || '/doc-' || CAST(doc_id AS VARCHAR) || '.txt' AS member,
         octet_length(encode(text)) AS size
  FROM documents)"""
_POSITION = "CAST(row_number() OVER (PARTITION BY archive ORDER BY doc_id) - 1 AS INT)"

SQL = {
    "archive_listing": f"""{_DOCS}
SELECT archive, {_POSITION} AS position, member, 'DEFLATE' AS method,
       CAST(size AS BIGINT) AS uncompressed_size, FALSE AS is_directory FROM docs""",
    "archive_summary": f"""{_DOCS}
SELECT archive, 'zip' AS kind, 'DEFLATE' AS methods, FALSE AS solid, COUNT(*) AS blocks,
       COUNT(*) AS members, CAST(SUM(size) AS BIGINT) AS total_uncompressed
FROM docs GROUP BY archive""",
    "archive_extract_all": "SELECT doc_id, text FROM documents",
    "archive_extract_prefix": f"""{_DOCS}
SELECT doc_id, text FROM docs
WHERE member IN ('en/doc-0.txt', 'en/doc-1.txt') OR member LIKE 'fr/%' OR member LIKE 'es/%'""",
    "archive_extract_named": "SELECT doc_id, text FROM documents "
    "WHERE doc_id IN (SELECT doc_id FROM labels)",
    "archive_integrity": f"""{_DOCS}, states AS (
  SELECT archive, CAST(substr(MIN(source), 4) AS INT) % 3 AS state, COUNT(*) AS n,
         arg_min(member, doc_id) AS first_member FROM docs GROUP BY archive)
SELECT archive, CASE state WHEN 0 THEN 'ok' WHEN 1 THEN 'bad' ELSE 'unreadable' END AS status,
       CASE WHEN state = 1 THEN first_member END AS first_bad,
       CASE WHEN state = 2 THEN 0 ELSE n END AS members_read
FROM states""",
    "archive_sniff": """
SELECT page_id,
       CASE page_id % 8 WHEN 0 THEN '7z' WHEN 1 THEN 'xz' WHEN 2 THEN 'zip' WHEN 3 THEN 'zstd'
            WHEN 4 THEN 'parquet' WHEN 5 THEN 'bzip2' WHEN 6 THEN 'gzip' ELSE 'unknown' END AS kind,
       CAST(octet_length(encode(html)) + CASE page_id % 8 WHEN 0 THEN 6 WHEN 1 THEN 6 WHEN 2 THEN 4
            WHEN 3 THEN 4 WHEN 4 THEN 4 WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 0 END AS BIGINT) AS length
FROM pages""",
    "member_path_check": """
WITH named AS (
  SELECT page_id, page_id % 8 AS k, CAST(page_id AS VARCHAR) || '.html' AS leaf FROM pages)
SELECT page_id,
  CASE k WHEN 0 THEN 'data/' WHEN 1 THEN '/abs/' WHEN 2 THEN '../' WHEN 3 THEN 'a/../' WHEN 4 THEN './b/'
         WHEN 5 THEN 'a/../../' WHEN 6 THEN '../out/' ELSE 'c//d/./' END || leaf AS member,
  CASE k WHEN 0 THEN '/landing/out/data/' || leaf WHEN 1 THEN '/landing/out/abs/' || leaf
         WHEN 3 THEN '/landing/out/' || leaf WHEN 4 THEN '/landing/out/b/' || leaf
         WHEN 6 THEN '/landing/out/' || leaf WHEN 7 THEN '/landing/out/c/d/' || leaf END AS resolved,
  CASE WHEN k IN (2, 5) THEN 'rejected' ELSE 'safe' END AS status
FROM named""",
    "duplicate_member_names": f"""{_DOCS}, numbered AS (
  SELECT archive, {_POSITION} AS position, lang,
         row_number() OVER (PARTITION BY archive, lang ORDER BY doc_id) AS nth FROM docs)
SELECT archive, position,
       lang || '.txt' || CASE WHEN nth = 1 THEN '' ELSE '_' || CAST(nth - 2 AS VARCHAR) END AS output_name
FROM numbered""",
    "landing_last_wins": f"""{_DOCS}
SELECT 'pair-' || CAST(doc_id // 2 AS VARCHAR) || '.txt' AS name,
       arg_max(text, archive || '-00000-00000.zip' || '#' || lpad(CAST(doc_id AS VARCHAR), 20, '0')) AS text
FROM docs GROUP BY doc_id // 2""",
    "archive_pack_roundtrip": "SELECT page_id, html FROM pages",
    "archive_volumes_roundtrip": "SELECT doc_id, text FROM documents",
    "archive_streamed_volumes": "SELECT doc_id, text FROM documents",
    "archive_listing_ranges": """SELECT doc_id,
       CAST(row_number() OVER (PARTITION BY doc_id // 2000 ORDER BY doc_id) - 1 AS INT) AS position,
       CAST(0 AS INT) AS occurrence, octet_length(encode(text)) AS size FROM documents""",
    "single_member_containers": " UNION ALL ".join(
        f"SELECT *, '{kind}' AS kind FROM customer" for kind in ("gzip", "bzip2")
    ),
}
