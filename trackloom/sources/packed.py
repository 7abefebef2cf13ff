"""Files of any layout, one record each, as a Spark data source.

The files below a folder are packed by size into lists of paths; a task gets one list, and
opens and decodes its files one after the other. Contents never leave the task that reads them:
what Spark moves is paths before and flat rows after. A file that cannot be read or
decoded is a row with ``error`` set. The sink writes one file per row, first to a folder beside the
target, which takes its place or whose files move into it when all tasks have succeeded.

Both use the file systems that Arrow knows (local, ``hdfs://``, ``s3://``, ``gs://``).
"""

from __future__ import annotations

import json
import posixpath
import struct
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StringType, StructField, StructType

# Bytes of files that a task reads, and what opening one counts as.
PARTITION_BYTES = 64 << 20
OPEN_BYTES = 1 << 20
# Tasks that opening files alone makes at most: of millions of small ones a task takes thousands.
OPENERS = 512
# Tasks a core that files are written by.
WRITERS = 4
ROWS = 1024


def _file_system(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return fs.LocalFileSystem(), path


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


def packed(files: list[tuple[str, int]], limit: int, opening: int = OPEN_BYTES) -> list[tuple[str, ...]]:
    """Lists of paths whose files have about ``limit`` bytes together: the largest first, each where most is free."""
    import heapq

    total = sum(size + opening for _, size in files)
    bins = [(0, i, []) for i in range(max(1, -(-total // limit)))]
    for path, size in sorted(files, key=lambda f: (-f[1], f[0])):
        filled, i, paths = heapq.heappop(bins)
        paths.append(path)
        heapq.heappush(bins, (filled + size + opening, i, paths))
    return [tuple(paths) for _, _, paths in sorted(bins) if paths]


def _as_text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return value.decode("utf-8", errors="replace") if isinstance(value, bytes) else str(value)


def _reader(decode: Callable[[bytes], dict], columns: list[str], pattern: str, limit: int):
    class Reader(DataSourceReader):
        def __init__(self, folder: str):
            self.folder = folder

        def partitions(self) -> list[Files]:
            from pyarrow import fs

            files, place = _file_system(self.folder)
            found = files.get_file_info(fs.FileSelector(place, recursive=True))
            wanted = [(f.path, f.size) for f in found if f.is_file and fnmatch(f.base_name, pattern) and not f.base_name.startswith((".", "_"))]
            opening = min(OPEN_BYTES, OPENERS * limit // max(1, len(wanted)))
            return [Files(paths) for paths in packed(wanted, limit, opening)]

        def read(self, partition: Files) -> Iterator:
            import pyarrow as pa

            files, _ = _file_system(self.folder)
            names = ["path", *columns, "error"]

            def one(path: str) -> list:
                try:
                    with files.open_input_stream(path) as stream:
                        record = decode(stream.read())
                    return [path, *(_as_text(record.get(c)) for c in columns), None]
                except Exception as problem:
                    return [path, *[None] * len(columns), f"{type(problem).__name__}: {problem}"]

            paths = partition.paths if partition else ()
            for start in range(0, len(paths), ROWS):
                rows = list(map(one, paths[start : start + ROWS]))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=names)

    return Reader


def read_records(
    spark: SparkSession,
    folder: str,
    decode: Callable[[bytes], dict],
    columns: list[str],
    pattern: str = "*",
    partition_bytes: int = PARTITION_BYTES,
) -> DataFrame:
    """path, the decoded ``columns`` as text, and error: one row per file below ``folder``.

    ``decode`` turns the bytes of one file into a dict. See :func:`trackloom.sources.records.typed_records`.
    """
    reader = _reader(decode, columns, pattern, partition_bytes)
    output = StructType([StructField(c, StringType()) for c in ["path", *columns, "error"]])
    source = f"records_{uuid.uuid4().hex}"

    class Records(DataSource):
        @classmethod
        def name(cls) -> str:
            return source

        def schema(self) -> StructType:
            return output

        def reader(self, schema: StructType) -> DataSourceReader:
            return reader(self.options["path"])

    spark.dataSource.register(Records)
    return spark.read.format(source).load(folder)


def read_texts(spark: SparkSession, folder: str, pattern: str = "*", partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """path, content (text) and error: one row per file below ``folder``."""
    return read_records(spark, folder, lambda content: {"content": content}, ["content"], pattern, partition_bytes)


@dataclass
class Written(WriterCommitMessage):
    attempt: str


class _FileWriter(DataSourceWriter):
    """Below the staging folder are ``files`` and, of each attempt at a task, a folder with its list of names."""

    def __init__(self, folder: str, staging: str):
        self.folder, self.staging = folder, staging

    def write(self, iterator: Iterator) -> Written:
        files, place = _file_system(self.staging)
        attempt = uuid.uuid4().hex
        own = posixpath.join(place, "attempts", attempt)
        # Tasks may run twice: a file appears whole, under its own name.
        part, names, folders = posixpath.join(own, "part"), {}, set()
        for name, content in iterator:
            target = posixpath.join(place, "files", name)
            if name in names:
                raise ValueError(f"two records are named {name}")
            if not names:
                files.create_dir(own, recursive=True)
            if posixpath.dirname(target) not in folders:
                files.create_dir(posixpath.dirname(target), recursive=True)
                folders.add(posixpath.dirname(target))
            with files.open_output_stream(part) as stream:
                stream.write(bytes(content))
            files.move(part, target)
            names[name] = None
        if names:
            with files.open_output_stream(posixpath.join(own, "names")) as stream:
                stream.write(json.dumps(list(names)).encode())
        return Written(attempt if names else "")

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        files, staged = _file_system(self.staging)
        _, place = _file_system(self.folder)
        done = [m.attempt for m in messages if m and m.attempt]
        if not done:
            return
        made, attempts = posixpath.join(staged, "files"), posixpath.join(staged, "attempts")
        # Where no attempt failed all files are wanted, and a new folder takes its place at once.
        alone = len(files.get_file_info(fs.FileSelector(attempts))) == len(done)
        new = files.get_file_info(place).type == fs.FileType.NotFound
        if alone and new and files.type_name in ("local", "hdfs"):
            if files.get_file_info(made).type == fs.FileType.Directory:
                files.move(made, place)
        else:
            folders = set()
            for attempt in done:
                with files.open_input_stream(posixpath.join(attempts, attempt, "names")) as stream:
                    names = json.loads(stream.read())
                for name in names:
                    target = posixpath.join(place, name)
                    if posixpath.dirname(target) not in folders:
                        files.create_dir(posixpath.dirname(target), recursive=True)
                        folders.add(posixpath.dirname(target))
                    files.move(posixpath.join(made, name), target)
        files.delete_dir(staged)

    def abort(self, messages: list) -> None:
        files, staged = _file_system(self.staging)
        for _ in range(5):  # tasks that are being stopped may write meanwhile
            try:
                if files.get_file_info(staged).type.name == "Directory":
                    files.delete_dir(staged)
            except OSError:
                pass
            time.sleep(0.5)
            if files.get_file_info(staged).type.name != "Directory":
                return


class RecordFiles(DataSource):
    """The sink: rows of name (a path below the folder) and content."""

    @classmethod
    def name(cls) -> str:
        return "record_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        folder = self.options["path"].rstrip("/")
        return _FileWriter(folder, f"{folder}._new-{uuid.uuid4().hex}")


def write_records(records: DataFrame, folder: str) -> None:
    """One file per row of ``records`` (name string, content binary) below ``folder``.

    Names are told apart within a task, so rows of one name, which are an error, go to one task; and
    opening a file takes its time whatever its size, so that rows are spread by number, not by bytes.
    """
    spark = records.sparkSession
    spark.dataSource.register(RecordFiles)
    spread = records.select("name", "content").repartition(WRITERS * spark.sparkContext.defaultParallelism, "name")
    spread.write.format("record_files").mode("append").save(folder)


# The layout of a binary track record. After the mark come three texts, each
# behind its length in bytes, and six numbers; all are in network order.
MARK = b"TRK1"
TEXTS = ["track_id", "track_name", "artist_name"]
NUMBERS = ["duration", "tempo", "loudness", "artist_familiarity", "artist_hotttnesss", "song_hotttnesss"]


def encode_track(record: dict) -> bytes:
    """The bytes of a track record; a missing text is empty, a missing number NaN."""
    texts = [(record.get(c) or "").encode() for c in TEXTS]
    numbers = [float("nan") if record.get(c) is None else float(record[c]) for c in NUMBERS]
    return MARK + b"".join(struct.pack(">H", len(t)) + t for t in texts) + struct.pack(">6d", *numbers)


def decode_track(content: bytes) -> dict:
    """The track record in ``content``; bytes that are missing or left over are an error."""
    if content[: len(MARK)] != MARK:
        raise ValueError("no track record")
    at, record = len(MARK), {}
    for column in TEXTS:
        (size,) = struct.unpack_from(">H", content, at)
        text = content[at + 2 : at + 2 + size]
        if len(text) < size:
            raise ValueError(f"cut short in {column}")
        record[column], at = text.decode(), at + 2 + size
    if len(content) - at != 8 * len(NUMBERS):
        raise ValueError("numbers are cut short or too many")
    return record | dict(zip(NUMBERS, struct.unpack_from(">6d", content, at)))
