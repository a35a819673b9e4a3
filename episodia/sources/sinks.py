"""Files as sinks, by Spark's Python data source API (survey rows S8, S21): tar shards, point clouds, plain files.

A task streams its rows into files of a folder of its own below _temporary; the driver moves them into place when all
tasks are done and deletes what is left of others, so that a job that fails or is aborted leaves no file, and a task
that runs twice leaves one result. Paths are those of pyarrow.fs: local ones, file://, hdfs://, s3:// and others.
"""

from __future__ import annotations

import io
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..operators.ranks import running_sum

TEMPORARY = "_temporary"


@dataclass
class Written(WriterCommitMessage):
    """Files that a task has finished: where they lie and what they are to be called."""

    files: list[tuple[str, str]] = field(default_factory=list)


class FileWriter(DataSourceWriter):
    """Streams a task's rows into files; subclasses say how in files()."""

    def __init__(self, options: dict[str, str], columns: list[str], overwrite: bool) -> None:
        if "path" not in options:
            raise ValueError("a sink needs a path")
        self.path, self.options, self.columns, self.overwrite = options["path"].rstrip("/"), dict(options), columns, overwrite
        self.job = f"{self.path}/{TEMPORARY}/{uuid.uuid4().hex}"

    def files(self, rows: Iterator) -> Iterator[tuple[str, Iterator[bytes]]]:
        """(name, pieces) of each file, its pieces in order."""
        raise NotImplementedError

    def write(self, iterator: Iterator) -> Written:
        done = Written()
        for name, pieces in self.files(iterator):
            store, path = fs.FileSystem.from_uri(f"{self.job}/{uuid.uuid4().hex}")
            store.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(path) as out:
                for piece in pieces:
                    out.write(piece)
            done.files.append((path, name))
        return done

    def commit(self, messages: list[Written | None]) -> None:
        store, path = fs.FileSystem.from_uri(self.path)
        files = [f for m in messages if m for f in m.files]
        if len({name for _, name in files}) < len(files):
            self.abort(messages)
            raise ValueError("two files of one name")
        store.create_dir(path, recursive=True)
        if self.overwrite:
            for info in store.get_file_info(fs.FileSelector(path)):
                if info.base_name != TEMPORARY:
                    (store.delete_dir if info.type == fs.FileType.Directory else store.delete_file)(info.path)
        for at, name in files:
            if "/" in name:
                store.create_dir(f"{path}/{name}".rsplit("/", 1)[0], recursive=True)
            store.move(at, f"{path}/{name}")
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        """Deletes this job's temporary files, and the common folder once no job has any there."""
        store, job = fs.FileSystem.from_uri(self.job)
        if store.get_file_info(job).type == fs.FileType.Directory:
            store.delete_dir(job)
        parent = job.rsplit("/", 1)[0]
        if store.get_file_info(parent).type == fs.FileType.Directory and not store.get_file_info(fs.FileSelector(parent)):
            store.delete_dir(parent)


class _Sink(DataSource):
    """A sink with a writer class; the frame's columns are given by position."""

    writer_class: type[FileWriter]

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return self.writer_class(self.options, [f.name for f in schema], overwrite)


def _of(columns: list[str], row: tuple, name: str) -> object:
    return row[columns.index(name)]


class PlainFileWriter(FileWriter):
    def files(self, rows):
        for row in rows:
            yield _of(self.columns, row, "name"), iter([bytes(_of(self.columns, row, "content"))])


class PlainFiles(_Sink):
    writer_class = PlainFileWriter

    @classmethod
    def name(cls) -> str:
        return "plain_files"


class TarWriter(FileWriter):
    def files(self, rows):
        pending = next(rows, None)

        def shard(number: int) -> Iterator[bytes]:
            nonlocal pending
            while pending is not None and _of(self.columns, pending, "shard") == number:
                key, payload = _of(self.columns, pending, "key"), bytes(_of(self.columns, pending, "payload") or b"")
                info = tarfile.TarInfo(key)
                info.size = len(payload)
                yield info.tobuf(tarfile.PAX_FORMAT)
                yield payload
                yield b"\0" * (-len(payload) % tarfile.BLOCKSIZE)
                pending = next(rows, None)
            yield b"\0" * (2 * tarfile.BLOCKSIZE)

        while pending is not None:
            number = _of(self.columns, pending, "shard")
            yield f"{self.options.get('split', 'train')}-{number:06d}.tar", shard(number)


class TarShards(_Sink):
    writer_class = TarWriter

    @classmethod
    def name(cls) -> str:
        return "tar_shards"


class PointCloudWriter(FileWriter):
    def files(self, rows):
        pending = next(rows, None)
        numbers = [c for c in ("x", "y", "z", "nx", "ny", "nz", "red", "green", "blue") if c in self.columns]
        kinds = [(c, "u1" if c in ("red", "green", "blue") else "<f8") for c in numbers]

        def cloud(name: str, n: int) -> Iterator[bytes]:
            nonlocal pending
            lines = [f"property {'uchar' if kind == 'u1' else 'double'} {c}" for c, kind in kinds]
            yield "\n".join(["ply", "format binary_little_endian 1.0", f"element vertex {n}", *lines, "end_header", ""]).encode()
            points: list[tuple] = []
            count = 0
            while pending is not None and _of(self.columns, pending, "cloud") == name:
                points.append(tuple(_of(self.columns, pending, c) for c in numbers))
                count += 1
                pending = next(rows, None)
                if len(points) == 4096:
                    yield np.array(points, kinds).tobytes()
                    points = []
            if count != n:
                raise ValueError(f"cloud {name} has {count} points in this task and {n} in all")
            yield np.array(points, kinds).tobytes()

        while pending is not None:
            name = _of(self.columns, pending, "cloud")
            yield f"{name}.ply", cloud(name, int(_of(self.columns, pending, "n")))


class PointClouds(_Sink):
    writer_class = PointCloudWriter

    @classmethod
    def name(cls) -> str:
        return "point_clouds"


def register_sinks(spark: SparkSession) -> None:
    """Makes the sinks known to the session, and the session this thread's active one, by which Spark looks them up."""
    spark.createDataFrame([], "nothing int")
    for sink in (PlainFiles, TarShards, PointClouds):
        spark.dataSource.register(sink)


def write_plain_files(files: DataFrame, path: str, mode: str = "append") -> None:
    """Files (name, content) below the path; names may have folders. A content is one value and fits into memory."""
    register_sinks(files.sparkSession)
    files.select("name", "content").write.format("plain_files").mode(mode).save(path)


def number_shards(samples: DataFrame, order: list[str], max_bytes: int) -> DataFrame:
    """Samples (key, payload) plus shard: a sample belongs to shard k if its first byte, of all payloads in order, lies
    in the k-th stretch of max_bytes. order: a number or text first, total; running sums in ranges find the place."""
    return running_sum(samples, order, F.octet_length("payload").cast("long"), "upto").withColumn("shard", F.floor((F.col("upto") - F.octet_length("payload")) / max_bytes).cast("long")).drop("upto")


def write_tar_shards(samples: DataFrame, path: str, split: str = "train", mode: str = "append") -> None:
    """Samples (shard, key, payload) as <split>-<shard>.tar, members in the order of their keys. A task holds one payload
    at a time, whatever a shard's size. Null payloads are empty members."""
    write_dealt_tar_shards(samples.select("shard", "key", "payload").repartition("shard").sortWithinPartitions("shard", "key"), path, split, mode)


def write_dealt_tar_shards(samples: DataFrame, path: str, split: str = "train", mode: str = "append") -> None:
    """As write_tar_shards(), of samples of which each shard lies in one task already, in the order of its members: none moves."""
    register_sinks(samples.sparkSession)
    samples.select("shard", "key", "payload").write.format("tar_shards").option("split", split).mode(mode).save(path)


def write_point_clouds(points: DataFrame, path: str, order: str, mode: str = "append") -> None:
    """Points (cloud, order, x, y, z; nx, ny, nz and red, green, blue if there) as one binary <cloud>.ply each, points in order."""
    register_sinks(points.sparkSession)
    numbers = [c for c in ("x", "y", "z", "nx", "ny", "nz", "red", "green", "blue") if c in points.columns]
    n = points.groupBy("cloud").agg(F.count(F.lit(1)).alias("n"))
    dealt = points.join(n, "cloud").repartition("cloud").sortWithinPartitions("cloud", order)
    dealt.select(F.col("cloud").cast("string").alias("cloud"), "n", *numbers).write.format("point_clouds").mode(mode).save(path)


def tar_members(content: bytes) -> Iterator[tuple[str, bytes]]:
    """(key, payload) of each file of a tar archive."""
    with tarfile.open(fileobj=io.BytesIO(content)) as tar:
        for member in tar:
            if member.isfile():
                yield member.name, tar.extractfile(member).read()


def read_point_cloud(content: bytes) -> np.ndarray:
    """The points of a PLY file as write_point_clouds() writes it."""
    header, body = content.split(b"end_header\n", 1)
    lines = [line.split() for line in header.decode().splitlines()]
    n = next(int(line[2]) for line in lines if line[:2] == ["element", "vertex"])
    return np.frombuffer(body, [(line[2], "u1" if line[1] == "uchar" else "<f8") for line in lines if line[0] == "property"], n)
