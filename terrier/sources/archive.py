"""An archive of equal-length arrays (``.npz``) as a data source: rows, from byte ranges of its members.

The archive is a ZIP of ``.npy`` members, one for each column, stored or deflated. Numbers are arrays;
texts are one array of bytes with a NUL between two. A first pass reads each text member as a stream
and notes where every so many rows begin; a task then reads its rows of every member and nothing else. Neither
the driver nor a task holds a member whole.
"""

from __future__ import annotations

import io
import json
import sys
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from numpy.lib import format as npy
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# What runs in tasks is shipped with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a partition, of one batch, and bytes read at once.
PARTITION_ROWS = 500_000
BATCH_ROWS = 50_000
READ_BYTES = 1 << 22

_KINDS = {"f8": "double", "f4": "float", "i8": "long", "i4": "integer", "i2": "short", "i1": "byte", "b1": "boolean"}


def _open(path: str):
    """A seekable stream of a file on any file system that Arrow knows by its address, or a local one."""
    if "://" not in path and not path.startswith("file:"):
        return open(path, "rb")
    if path.startswith("file:"):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    system, inner = pafs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _header(member) -> tuple[np.dtype, int]:
    """The type and the number of elements that a member states, with the stream behind its header."""
    version = npy.read_magic(member)
    shape, fortran, kind = (npy.read_array_header_1_0 if version == (1, 0) else npy.read_array_header_2_0)(member)
    if len(shape) != 1:
        raise ValueError(f"an array of {len(shape)} dimensions is no column")
    return kind, shape[0]


def members(path: str) -> dict[str, np.dtype]:
    """Column names and element types, in the order of the archive."""
    found = {}
    with _open(path) as file, zipfile.ZipFile(file) as archive:
        for name in archive.namelist():
            with archive.open(name) as member:
                found[name.removesuffix(".npy")] = _header(member)[0]
    return found


def _blocks(member, length: int) -> Iterator[bytes]:
    while length:
        block = member.read(min(READ_BYTES, length))
        if not block:
            raise ValueError("a member of the archive ends early")
        length -= len(block)
        yield block


def text_starts(path: str, column: str, every: int) -> tuple[int, list[int]]:
    """Rows of a text column, and the byte at which each ``every``-th one begins; read as a stream."""
    with _open(path) as file, zipfile.ZipFile(file) as archive, archive.open(f"{column}.npy") as member:
        _, length = _header(member)
        rows, at, starts = 1, 0, [0]  # the text after the last NUL is a row too
        for block in _blocks(member, length):
            ends = np.flatnonzero(np.frombuffer(block, np.uint8) == 0)
            wanted = np.arange(-(-rows // every) * every, rows + len(ends), every)
            starts += (at + ends[wanted - rows] + 1).tolist()
            rows, at = rows + len(ends), at + len(block)
        return rows, starts


def _skip(member, length: int) -> None:
    """Move on; a deflated member has to be read for it, a stored one is not."""
    member.seek(length, io.SEEK_CUR)


def _texts(member, count: int, length: int) -> Iterator[list[str]]:
    """``count`` texts in lists of at most BATCH_ROWS; ``length`` bytes are left in the member."""
    rest, held, given = b"", [], 0
    for block in _blocks(member, length):
        *whole, rest = (rest + block).split(b"\x00")
        held += whole
        while len(held) >= BATCH_ROWS or given + len(held) >= count:
            part = held[: min(BATCH_ROWS, count - given)]
            held, given = held[len(part) :], given + len(part)
            yield [t.decode("utf-8") for t in part]
            if given >= count:
                return
    held.append(rest)
    for start in range(0, count - given, BATCH_ROWS):
        yield [t.decode("utf-8") for t in held[start : min(start + BATCH_ROWS, count - given)]]


def _numbers(member, kind: np.dtype, count: int) -> Iterator[np.ndarray]:
    for start in range(0, count, BATCH_ROWS):
        n = min(BATCH_ROWS, count - start)
        data = b"".join(_blocks(member, n * kind.itemsize))
        # Native byte order, which Arrow asks for.
        yield np.frombuffer(data, kind).astype(kind.newbyteorder("="))


class Rows(InputPartition):
    def __init__(self, first: int, count: int, starts: dict[str, int]):
        self.first, self.count, self.starts = first, count, starts


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, rows: int):
        self.path, self.names, self.every = path, schema.names, rows

    def partitions(self) -> list[Rows]:
        kinds, starts, lengths = members(self.path), {}, {}
        for name in self.names:
            if kinds[name] == np.uint8:
                lengths[name], starts[name] = text_starts(self.path, name, self.every)
            else:
                with _open(self.path) as file, zipfile.ZipFile(file) as archive, archive.open(f"{name}.npy") as member:
                    lengths[name] = _header(member)[1]
        if len(set(lengths.values())) > 1:
            raise ValueError(f"the columns of the archive differ in length: {lengths}")
        total = next(iter(lengths.values()), 0)
        return [
            Rows(first, min(self.every, total - first), {n: s[first // self.every] for n, s in starts.items()})
            for first in range(0, total, self.every)
        ] or [Rows(0, 0, {})]

    def read(self, rows: Rows) -> Iterator[pa.RecordBatch]:
        if not rows.count:
            return
        with _open(self.path) as file, zipfile.ZipFile(file) as archive:
            streams = []
            for name in self.names:
                member = archive.open(f"{name}.npy")
                kind, length = _header(member)
                if name in rows.starts:
                    _skip(member, rows.starts[name])
                    streams.append(_texts(member, rows.count, length - rows.starts[name]))
                else:
                    _skip(member, rows.first * kind.itemsize)
                    streams.append(_numbers(member, kind, rows.count))
            for columns in zip(*streams, strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=self.names)


class ArchiveSource(DataSource):
    """``spark.read.format("npz")``: option ``path``; ``rows`` is the size of a partition."""

    @classmethod
    def name(cls) -> str:
        return "npz"

    def schema(self) -> T.StructType:
        known = self.options.get("members")
        kinds = json.loads(known) if known else {n: k.str for n, k in members(self.options["path"]).items()}
        fields = []
        for name, kind in kinds.items():
            plain = "string" if kind.endswith("u1") else _KINDS.get(kind[1:])
            if plain is None:
                raise ValueError(f"column {name} has elements of type {kind}")
            fields.append(T.StructField(name, T.StringType() if plain == "string" else T._parse_datatype_json_value(plain)))
        return T.StructType(fields)

    def reader(self, schema: T.StructType) -> ArchiveReader:
        return ArchiveReader(self.options["path"], schema, int(self.options.get("rows", PARTITION_ROWS)))


def read_archive(spark: SparkSession, path: str, rows: int = PARTITION_ROWS) -> DataFrame:
    """The rows of an archive, ``rows`` to a partition.

    Columns have the names and order of the members. Texts are UTF-8; an empty one stays empty, and the
    text after the last NUL is a row. NaN stays NaN. Arrays of other lengths, of more dimensions or of types
    without a column type raise. The path is one that the driver and the executors can open.
    """
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("npz").option("path", path).option("rows", str(rows)).load()
