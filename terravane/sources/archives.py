"""Nested zip archives unpacked by the executors, their members spread over the tasks."""

from __future__ import annotations

import posixpath
import shutil
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.functions.names import base_name, has_suffix, member_path

COPY_BYTES = 8 << 20
MEMBERS = pa.schema([("archive", pa.string()), ("member", pa.string()), ("bytes", pa.int64())])
FILES = pa.schema([("path", pa.string()), ("bytes", pa.int64())])


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path on it: a mounted folder or any store Arrow knows."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@contextmanager
def open_archive(path: str) -> Iterator[zipfile.ZipFile]:
    """Zip file opened for random access: only the parts that are used are read."""
    store, inner = store_of(path)
    with store.open_input_file(inner) as handle, zipfile.ZipFile(handle) as archive:
        yield archive


def _batches(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def list_members(spark: SparkSession, archives: list[str], suffix: str, tasks: int) -> DataFrame:
    """One row per member ending in ``suffix``. Only the directory of each zip is read."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                with open_archive(path) as archive:
                    yield _batches(
                        [
                            {"archive": path, "member": i.filename, "bytes": i.file_size}
                            for i in archive.infolist()
                        ],
                        MEMBERS,
                    )

    listed = spark.createDataFrame([(a,) for a in archives], "archive string")
    members = listed.repartition(tasks).mapInArrow(scan, "archive string, member string, bytes long")
    return members.where(has_suffix(F.col("member"), suffix))


def extract_members(members: DataFrame, tasks: int) -> DataFrame:
    """Write every member to its ``target`` path and return ``path, bytes``.

    Members, not archives, are spread over the tasks, so that the archive holding most of
    the extract is unpacked by many tasks. A member is streamed in blocks to a name of its
    own and then moved, so a task that is lost and run again leaves whole files only.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_archive(row["archive"]) as archive, archive.open(row["member"]) as source:
                    size = _write(source, row["target"])
                yield _batches([{"path": row["target"], "bytes": size}], FILES)

    spread = members.select("archive", "member", "target").repartition(tasks)
    return spread.mapInArrow(unpack, "path string, bytes long")


def _write(source, target: str) -> int:
    store, path = store_of(target)
    folder = posixpath.dirname(path)
    store.create_dir(folder, recursive=True)
    # a leading underscore hides the unfinished file from Spark readers
    partial = posixpath.join(folder, f"_{uuid.uuid4().hex}")
    try:
        with store.open_output_stream(partial) as sink:
            shutil.copyfileobj(source, sink, COPY_BYTES)
            size = sink.tell()
    except BaseException:
        store.delete_file(partial)
        raise
    store.move(partial, path)
    return size


def refuse_collisions(members: DataFrame) -> DataFrame:
    """``members`` if their targets differ; else an error before anything is written."""
    twice = members.groupBy("target").agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if twice:
        raise ValueError(f"{twice['n']} members would be written to {twice['target']}")
    return members


def _remove(paths: DataFrame) -> None:
    """Delete files that an earlier extract left, by the tasks that find them."""

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, inner = store_of(path)
                if store.get_file_info(inner).type != fs.FileType.NotFound:
                    store.delete_file(inner)
            yield batch

    paths.mapInArrow(drop, "path string").write.format("noop").mode("overwrite").save()


def _exists(path: str) -> bool:
    store, inner = store_of(path)
    return store.get_file_info(inner).type != fs.FileType.NotFound


def expand(
    spark: SparkSession, archive: str, folder: str, tasks: int | None = None
) -> DataFrame:
    """Outer zip to inner zips to XML files ``<folder>/<type code>/<name>.xml``.

    The result lists the written files; it is read from disk, so using it twice does not
    unpack twice. Two members for one file are an error, found before any is unpacked. Files
    that an earlier extract wrote to ``folder`` and this one does not are deleted.
    """
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    inner = list_members(spark, [archive], ".zip", 1).withColumn(
        "target", F.concat_ws("/", F.lit(f"{folder}/_archives"), base_name(F.col("member")))
    )
    # one inner zip per object type: the only list that returns to the driver
    paths = [r["path"] for r in extract_members(refuse_collisions(inner), tasks).collect()]
    members = list_members(spark, paths, ".xml", max(1, len(paths))).withColumn(
        "target", member_path(folder, F.col("archive"), F.col("member"))
    )
    manifest, fresh = f"{folder}/_files", f"{folder}/_files-{uuid.uuid4().hex}"
    extract_members(refuse_collisions(members), tasks).write.parquet(fresh)
    written = spark.read.parquet(fresh)
    if _exists(manifest):
        earlier = spark.read.parquet(manifest)
        _remove(earlier.join(written, "path", "left_anti").select("path"))
    written.write.mode("overwrite").parquet(manifest)
    store, inner_path = store_of(fresh)
    store.delete_dir(inner_path)
    return spark.read.parquet(manifest)
