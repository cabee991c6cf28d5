"""A data source for the lines of zip archives, read by seek.

``spark.read.format("zip_lines")`` takes archives of any size: a task opens its archive at the end,
reads the central directory, goes to the largest member and streams it, a batch of lines at a
time.  Neither an archive nor a member is ever held whole.  A deflated member cannot be split, so an archive is one partition.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMES = {"", "file", "hdfs", "s3", "s3a", "s3n", "gs", "gcs", "abfs", "abfss"}  # that Arrow opens by seek
_BLOCK = 1 << 20  # bytes that are inflated at once


@dataclass
class Archive(InputPartition):
    path: str


class Seekable(io.RawIOBase):
    """An Arrow file with Python's errors: a seek beyond an end is an OSError, which the zip reader looks for."""

    def __init__(self, file):
        self.file = file

    def readable(self):
        return True

    def seekable(self):
        return True

    def tell(self):
        return self.file.tell()

    def seek(self, offset, whence=0):
        try:
            return self.file.seek(offset, whence)
        except pa.ArrowInvalid as e:
            raise OSError(str(e)) from e

    def readinto(self, buffer):
        return self.file.readinto(buffer)

    def close(self):
        self.file.close()
        super().close()


def opened(path: str) -> Seekable:
    """A seekable file of the archive."""
    from pyarrow import fs

    uri = path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1)
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = uri.replace("file:", "file://", 1)
    if "://" not in uri:
        return Seekable(fs.LocalFileSystem().open_input_file(uri))
    if uri.startswith("file://"):  # the path as it is, percent signs and spaces too
        return Seekable(fs.LocalFileSystem().open_input_file(uri[7:]))
    system, own = fs.FileSystem.from_uri(uri)
    return Seekable(system.open_input_file(own))


def lines(path: str, encoding: str, batch_lines: int) -> Iterator[list[str]]:
    """Batches of the lines of the largest member, without line ends; blank lines are left out."""
    import zipfile

    with opened(path) as raw, zipfile.ZipFile(raw) as archive:
        members = [m for m in archive.infolist() if not m.is_dir()]
        if not members:
            raise ValueError(f"{path} is an empty zip file")
        rest, out = b"", []
        with archive.open(max(members, key=lambda m: m.file_size)) as member:
            while block := member.read(_BLOCK):
                *whole, rest = (rest + block).split(b"\n")
                for line in whole:
                    if line.rstrip(b"\r"):
                        out.append(line.rstrip(b"\r").decode(encoding))
                        if len(out) >= batch_lines:
                            yield out
                            out = []
        if rest.rstrip(b"\r"):
            out.append(rest.rstrip(b"\r").decode(encoding))
        if out:
            yield out


class ZipReader(DataSourceReader):
    def __init__(self, options):
        self.paths = json.loads(options["paths"])
        self.encoding = options.get("encoding", "latin-1")
        self.batch_lines = int(options.get("batchLines", "65536"))

    def partitions(self):
        return [Archive(p) for p in self.paths]

    def read(self, partition):
        for batch in lines(partition.path, self.encoding, self.batch_lines):
            yield pa.RecordBatch.from_pydict({"value": batch, "source": [partition.path] * len(batch)})


class ZipLines(DataSource):
    @classmethod
    def name(cls):
        return "zip_lines"

    def schema(self):
        return "value string, source string"

    def reader(self, schema):
        return ZipReader(self.options)


def read_archives(spark: SparkSession, paths: list[str], *, encoding: str, batch_lines: int):
    spark.dataSource.register(ZipLines)
    return (spark.read.format("zip_lines").option("paths", json.dumps(paths)).option("encoding", encoding)
            .option("batchLines", batch_lines).load())
