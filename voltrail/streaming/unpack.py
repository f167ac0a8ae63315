"""Archives unpacked as they arrive, to files or to rows."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltrail.functions.columns import resolved_member_path
from voltrail.session import qualify
from voltrail.sources import archives, messages
from voltrail.streaming import FILES_PER_BATCH, stream_id


REPLACED = "a later member has the same target"
# File names have 255 bytes; a file being written has a longer name for a while.
NAME_BYTES = 255 - 40


def _status() -> Column:
    return (
        F.when(F.col("error").isNotNull(), "unreadable")
        .when(F.col("position").isNull(), "empty")
        .when(F.col("is_directory"), "directory")
        .when(F.col("problem") == REPLACED, "replaced")
        .when(F.col("target").isNull(), "rejected")
        .when(F.col("read_error").isNotNull(), "damaged")
        .otherwise("landed")
    )


def _manifest(landed: DataFrame) -> DataFrame:
    return landed.select(
        "path",
        "position",
        "member",
        "target",
        _status().alias("status"),
        F.coalesce("error", "read_error", F.nullif("problem", F.lit(REPLACED))).alias("error"),
        F.col("bytes_read").alias("bytes"),
        F.col("data_crc32").alias("crc32"),
    )


def settled_targets(members: DataFrame) -> DataFrame:
    """Adds `problem`, and takes the `target` from members that cannot be landed.

    Of several members with one target the last of the archive stays, the others are
    replaced. A target that other members need as a folder, or whose name is longer than
    file systems take with the writer's suffix, is refused: told from names alone, before
    any file is touched.
    """
    name = F.element_at(F.split("target", "/"), -1)
    steps = F.split(F.regexp_replace("target", "^[a-z0-9]+:/+", "/"), "/")
    folders = members.where(F.col("target").isNotNull()).select(
        F.explode(
            F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
        ).alias("folder")
    )
    clear = F.regexp_replace("target", "^[a-z0-9]+:/+", "/")
    last = Window.partitionBy("target").orderBy(F.desc("position"), F.desc("path"))
    # Folders, errors and empty archives have no target: they are none of the window's
    # business, and there may be very many of them.
    placed = (
        members.where(F.col("target").isNotNull())
        .withColumn("place", F.row_number().over(last))
        .join(folders.distinct(), clear == F.col("folder"), "left")
        .withColumn(
            "problem",
            F.when(F.col("folder").isNotNull(), "other members need this name as a folder")
            .when(F.octet_length(name) > NAME_BYTES, "name too long")
            .when(F.col("place") > 1, REPLACED),
        )
    )
    placed = placed.withColumn("target", F.when(F.col("problem").isNull(), F.col("target"))).drop("place", "folder")
    placeless = members.where(F.col("target").isNull()).withColumn("problem", F.lit(None).cast("string"))
    return placed.unionByName(placeless)


def land_archives(archive_files: DataFrame, source: str, target: str) -> DataFrame:
    """Members as files below `target`, in a folder per archive; returns the manifest.

    Each member keeps its path, so members of equal name do not replace each other.
    """
    root, source_root = qualify(archive_files.sparkSession, target), qualify(archive_files.sparkSession, source)
    listed = archives.with_output_names(archives.inventory(archive_files, measure=False))
    # Spark and Hadoop differ in the slashes after the scheme; compare from the path on.
    below = F.regexp_replace("path", "^[a-z0-9]+:/+", "/")
    prefix = "/" + source_root.split(":", 1)[-1].strip("/") + "/"
    folder = F.when(
        below.startswith(prefix), F.substring(below, F.lit(len(prefix) + 1), F.length(below))
    ).otherwise(F.substring(below, F.lit(2), F.length(below)))
    inside = resolved_member_path(F.col("output_name"), "/member")
    is_data = F.col("position").isNotNull() & ~F.col("is_directory")
    relative = F.substring(inside, F.lit(len("/member/") + 1), F.length(inside))
    target_file = F.when(
        is_data & (F.length(relative) > 0), F.concat(F.lit(root + "/"), folder, F.lit("/"), relative)
    )
    rows = settled_targets(listed.withColumn("target", target_file))
    return _manifest(archives.land_members(rows, archives.partition_count(archive_files)))


def land_archives_flat(archive_files: DataFrame, target: str) -> DataFrame:
    """Members as files directly in `target`; of equal base names the last one stays."""
    root = qualify(archive_files.sparkSession, target)
    listed = archives.inventory(archive_files, measure=False)
    winners = archives.last_by_base_name(archives.members_of(listed)).withColumn(
        "target",
        F.when(F.col("base_name").isin("", ".", ".."), F.lit(None)).otherwise(
            F.concat(F.lit(root + "/"), "base_name")
        ),
    )
    unread = listed.where(F.col("position").isNull())
    rows = settled_targets(winners.drop("base_name").unionByName(unread, allowMissingColumns=True))
    return _manifest(archives.land_members(rows, archives.partition_count(archive_files)))


def unpack_notified(notifications: DataFrame, root: str, target: str, manifest: str, run_id: str) -> DataFrame:
    """Lands the archives that a table of messages names; returns the manifest.

    Takes messages to files: keys of records, those of raw archives, each once, looked up
    below `root`, members landed below `target`. What became of each member, and messages
    that are no JSON, are written below `manifest` under the run's id. The same run again
    lands the same files and replaces what it wrote.
    """
    spark = notifications.sparkSession
    keys = messages.wanted_archives(messages.object_keys(notifications))
    landed = land_archives(archives.locate_archives(keys, qualify(spark, root)), root, target)
    places = [f"{manifest}/{kind}/run={quote(run_id, safe='')}" for kind in ("members", "rejected")]
    landed.write.mode("overwrite").parquet(places[0])
    messages.rejected_messages(notifications).write.mode("overwrite").parquet(places[1])
    return spark.read.schema(landed.schema).parquet(places[0])


def message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = FILES_PER_BATCH) -> DataFrame:
    """Messages (`body`) from JSON files as they arrive."""
    reader = spark.readStream.schema("body string").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def unpack_notified_stream(
    notifications: DataFrame,
    root: str,
    target: str,
    manifest: str,
    checkpoint: str,
    name: str = "unpack-notified",
    remember: str = "7 days",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Lands the archives that arriving messages name, each upload once.

    The stream's state keeps what it was told for the time `remember`, so a message that
    is sent again lands nothing again, in a later batch or after a restart either. Time is
    that of the batch: no message is too late, however old the event it tells of. What a
    batch was told, what became of the members, and bodies that are no JSON are below
    `manifest` under stream and batch; a batch played again replaces them.
    """
    spark = notifications.sparkSession
    told = (
        messages.notified(notifications)
        .withColumn("seen", F.current_timestamp())
        .withWatermark("seen", remember)
        .dropDuplicatesWithinWatermark(["kind", "key", "version"])
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        place = f"stream={stream_id(batch, name)}/batch_id={batch_id}"
        # Kept before it is used twice: the batch itself would ask the state twice.
        batch.drop("seen").write.mode("overwrite").parquet(f"{manifest}/told/{place}")
        rows = spark.read.schema("kind string, key string, version string").parquet(f"{manifest}/told/{place}")
        rejected = rows.where("kind = 'rejected'").select(F.col("key").alias("body"))
        rejected.write.mode("overwrite").parquet(f"{manifest}/rejected/{place}")
        keys = messages.wanted_archives(rows.where("kind = 'object'"))
        landed = land_archives(archives.locate_archives(keys, qualify(spark, root)), root, target)
        landed.write.mode("overwrite").parquet(f"{manifest}/members/{place}")

    return (
        told.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(land)
        .start()
    )


def _run(
    archive_files: DataFrame, per_batch, output: str, checkpoint: str, name: str, trigger: dict | None
) -> StreamingQuery:
    """Writes what `per_batch` returns under stream and batch; a repeated batch replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        place = f"{output}/stream={stream_id(batch, name)}/batch_id={batch_id}"
        per_batch(batch).write.mode("overwrite").parquet(place)

    return (
        archive_files.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


def unpack_to_files(
    spark: SparkSession,
    source: str,
    target: str,
    manifest: str,
    checkpoint: str,
    flat: bool = False,
    glob: str | None = None,
    name: str = "unpack-files",
    max_files_per_trigger: int | None = FILES_PER_BATCH,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Lands the members of new archives as files and records what became of each."""

    def land(batch: DataFrame) -> DataFrame:
        return land_archives_flat(batch, target) if flat else land_archives(batch, source, target)

    files = archives.stream_archives(spark, source, glob, max_files_per_trigger)
    return _run(files, land, manifest, checkpoint, name, trigger)


def unpack_to_rows(
    spark: SparkSession,
    source: str,
    output: str,
    checkpoint: str,
    glob: str | None = None,
    name: str = "unpack-rows",
    max_files_per_trigger: int | None = FILES_PER_BATCH,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Stores the members of new archives as rows; unreadable ones keep their error."""

    def read(batch: DataFrame) -> DataFrame:
        rows = archives.read_inventory(archives.inventory(batch, measure=False), archives.partition_count(batch))
        return rows.select(
            "path",
            "position",
            "member",
            "is_directory",
            "chunk",
            "data",
            F.coalesce("error", "read_error").alias("error"),
        )

    files = archives.stream_archives(spark, source, glob, max_files_per_trigger)
    return _run(files, read, output, checkpoint, name, trigger)


def unpacked_rows(spark: SparkSession, output: str) -> DataFrame:
    """Member data stored by `unpack_to_rows`."""
    rows = spark.read.parquet(output)
    return rows.where(F.col("error").isNull() & F.col("chunk").isNotNull())


def quarantine(spark: SparkSession, output: str) -> DataFrame:
    """Archives and members that could not be read, from either unpacker's output."""
    rows = spark.read.parquet(output)
    return rows.where(F.col("error").isNotNull()).select("path", "member", "error")
