"""Nested archives as a data source: tasks read records straight from the zips.

Nothing is unpacked to disk, so a task that is lost leaves nothing behind, and what the driver
holds is the list of inner archives, not of their members.
"""

from __future__ import annotations

import codecs
import posixpath
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from terravane.sources.archives import open_archive, store_of
from terravane.sources.xml import CLOSING, cut_records

SOURCE = "zip_members"
#: Bytes of an inner archive that one task reads, about; of a member, at a time; rows of a batch.
SLICE_BYTES, BLOCK_BYTES, BATCH_BYTES = 64 << 20, 1 << 20, 4 << 20
SCHEMA = "archive string, member string, value string"


def archives_at(path: str) -> list[str]:
    """The archive itself, or the zips in a folder."""
    store, inner = store_of(path)
    if store.get_file_info(inner).type != fs.FileType.Directory:
        return [path]
    root = path.rstrip("/")
    found = store.get_file_info(fs.FileSelector(inner))
    return sorted(f"{root}/{f.base_name}" for f in found if f.base_name.endswith(".zip"))


@dataclass
class Slice(InputPartition):
    """Every ``count``-th member of an inner archive, from the ``index``-th on."""

    archive: str
    inner: str
    index: int
    count: int


class MembersReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.suffix = options["path"], options.get("suffix", ".xml")
        self.slice_bytes = int(options.get("slicebytes", SLICE_BYTES))

    def partitions(self) -> list[InputPartition]:
        """Slices of all inner archives; only the directory of each outer zip is read."""
        slices = []
        for archive in archives_at(self.path):
            with open_archive(archive) as outer:
                for info in outer.infolist():
                    if info.filename.endswith(".zip"):
                        count = max(1, -(-info.file_size // self.slice_bytes))
                        slices += [Slice(archive, info.filename, i, count) for i in range(count)]
        return slices

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        with open_archive(partition.archive) as outer, outer.open(partition.inner) as source:
            with zipfile.ZipFile(source) as inner:
                names = [n for n in inner.namelist() if n.endswith(self.suffix)]
                for name in names[partition.index :: partition.count]:
                    with inner.open(name) as member:
                        for values in _batches(pieces(member)):
                            origin = [[posixpath.basename(x)] * len(values) for x in (partition.inner, name)]
                            columns = [pa.array(c, pa.string()) for c in (*origin, values)]
                            yield pa.RecordBatch.from_arrays(columns, ["archive", "member", "value"])


def pieces(member) -> Iterator[str]:
    """Text of a member up to each closing tag of a record, and what is left behind the last."""
    decode, rest = codecs.getincrementaldecoder("utf-8")().decode, ""
    while block := member.read(BLOCK_BYTES):
        *whole, rest = (rest + decode(block)).split(CLOSING)
        yield from whole
    rest += decode(b"", final=True)
    if rest.strip():
        yield rest


def _batches(values: Iterator[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for value in values:
        held.append(value)
        size += len(value)
        if size >= BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


class ArchiveMembers(DataSource):
    """``zip_members``: ``archive``, ``member`` and ``value`` of the members of nested zips.

    ``path`` is an archive or a folder of archives, ``suffix`` what a member's name ends in.
    """

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return MembersReader(self.options)


def archive_records(spark: SparkSession, path: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``record``, ``archive`` and ``member`` of every record in the members of nested zips."""
    spark.dataSource.register(ArchiveMembers)
    values = spark.read.format(SOURCE).option("slicebytes", slice_bytes).load(path)
    return cut_records(values).select("record", "archive", "member")


@contextmanager
def _sink(target: str):
    """Stream to a name of its own that becomes ``target`` when it is complete."""
    store, path = store_of(target)
    folder = posixpath.dirname(path)
    store.create_dir(folder, recursive=True)
    partial = posixpath.join(folder, f"_{uuid.uuid4().hex}")
    try:
        with store.open_output_stream(partial) as stream:
            yield stream
    except BaseException:
        store.delete_file(partial)
        raise
    store.move(partial, path)


def write_archives(members: DataFrame, folder: str) -> DataFrame:
    """Write ``archive``, ``inner``, ``member`` and ``content`` as nested zips below ``folder``.

    Returns ``path`` and ``members`` of each archive when it is run. A task writes an archive
    front to back, as rows arrive in order; inner archives are stored in it as they are.
    """
    names = ["archive", "inner", "member", "content"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for archive, own in groupby(rows, key=itemgetter(0)):
            target, count = f"{folder}/{archive}", 0
            with _sink(target) as stream, zipfile.ZipFile(stream, "w") as outer:
                for inner, nested in groupby(own, key=itemgetter(1)):
                    with outer.open(inner, "w", force_zip64=True) as slot:
                        with zipfile.ZipFile(slot, "w", zipfile.ZIP_DEFLATED) as packed:
                            for _, _, member, content in nested:
                                packed.writestr(member, content)
                                count += 1
            yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([count])], ["path", "members"])

    ordered = members.select(*names).repartition("archive").sortWithinPartitions(*names[:3])
    return ordered.mapInArrow(pack, "path string, members long")
