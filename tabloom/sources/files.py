"""Real files: writing one per row, and a data source that lists files, reads image headers and hashes contents piece by piece."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tabloom.functions.scalar import basename

#: Bytes of a file that are held at a time, and what one task reads at most (files are never cut).
PIECE_BYTES, TASK_BYTES, TASK_FILES = 1 << 20, 256 << 20, 2_000
#: Bytes that hold the header of a PNG, GIF or BMP; a JPEG is walked segment by segment.
HEAD_BYTES = 32
COLUMNS = ("path string, length long, modified timestamp, width int, height int, channels int, sha1 string")


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it. Spark writes local addresses with one slash."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def image_size(read, skip) -> tuple[int, int, int] | None:
    """(width, height, channels) from the header of a PNG, JPEG, GIF or BMP; None for anything else.

    ``read(n)`` gives the next n bytes, ``skip(n)`` passes over them. The layouts are those of the public formats.
    """
    head = read(HEAD_BYTES)
    if head[:8] == b"\x89PNG\r\n\x1a\n" and len(head) >= 26:
        width, height = struct.unpack(">II", head[16:24])
        return width, height, {0: 1, 2: 3, 3: 3, 4: 2, 6: 4}.get(head[25], 0)
    if head[:6] in (b"GIF87a", b"GIF89a"):
        width, height = struct.unpack("<HH", head[6:10])
        return width, height, 3
    if head[:2] == b"BM" and len(head) >= 30:
        width, height = struct.unpack("<ii", head[18:26])
        return width, abs(height), max(1, struct.unpack("<H", head[28:30])[0] // 8)
    if head[:2] == b"\xff\xd8":
        rest = head[2:]

        def take(n: int) -> bytes:
            nonlocal rest
            if len(rest) < n:
                rest += read(n - len(rest))
            out, rest = rest[:n], rest[n:]
            return out

        while True:
            mark = take(2)
            if len(mark) < 2 or mark[0] != 0xFF:
                return None
            if mark[1] == 0xFF:
                rest = mark[1:] + rest
                continue
            if mark[1] in (0x01, *range(0xD0, 0xD9)):
                continue
            size = take(2)
            if len(size) < 2:
                return None
            n = struct.unpack(">H", size)[0] - 2
            if 0xC0 <= mark[1] <= 0xCF and mark[1] not in (0xC4, 0xC8, 0xCC):
                frame = take(6)
                return (*struct.unpack(">HH", frame[1:5])[::-1], frame[5]) if len(frame) == 6 else None
            inside = min(n, len(rest))
            rest = rest[inside:]
            skip(n - inside)
    return None


class _Files(InputPartition):
    def __init__(self, files: list[tuple[str, int, float | None]]):
        super().__init__(len(files))
        self.files = files


class FileMetaReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.hashed = options.get("hash", "false").lower() == "true"
        self.images = options.get("images", "false").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        """Files of the folder, several small ones per task. Names that Spark reads as hidden are left out."""
        system, root = filesystem(self.root)
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted((i.path, i.size or 0, i.mtime_ns / 1e9 if i.mtime_ns else None) for i in found
                       if i.type == fs.FileType.File and i.base_name[:1] not in "._")
        out, held, size = [], [], 0
        for f in files:
            read = f[1] if self.hashed else 4096
            if held and (size + read > TASK_BYTES or len(held) >= TASK_FILES):
                out.append(_Files(held))
                held, size = [], 0
            held.append(f)
            size += read
        return [*out, _Files(held)]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        system, _ = filesystem(self.root)
        rows = []
        for path, length, modified in partition.files:
            size, digest = None, None
            if self.images:
                with system.open_input_file(path) as f:
                    size = image_size(f.read, lambda n: f.seek(f.tell() + n))
            if self.hashed:
                total = hashlib.sha1()
                with system.open_input_stream(path) as f:
                    while piece := f.read(PIECE_BYTES):
                        total.update(piece)
                digest = total.hexdigest()
            rows.append((path, length, None if modified is None else int(modified * 1e6), *(size or (None, None, None)), digest))
        columns = list(zip(*rows)) if rows else [[] for _ in range(7)]
        kinds = [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.int32(), pa.int32(), pa.int32(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in COLUMNS.split(", ")])


class FileMeta(DataSource):
    """``spark.read.format("file_meta")``: one row per file below ``path``: path, length, time of change; with ``images`` its size and
    channels, of which only the header is read; with ``hash`` its SHA-1, read piece by piece, so that files of any length work."""

    @classmethod
    def name(cls) -> str:
        return "file_meta"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> FileMetaReader:
        return FileMetaReader(self.options)


def file_meta(spark: SparkSession, path: str, hashed: bool = False, images: bool = False) -> DataFrame:
    spark.dataSource.register(FileMeta)
    return spark.read.format("file_meta").option("hash", hashed).option("images", images).load(path)


def read_image_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(file, width, height, channels) of every file that is an image; others have nulls."""
    return file_meta(spark, path, images=True).select(basename("path").alias("file"), "width", "height", "channels")


def hash_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, sha1_local) of every file, whatever its length."""
    return file_meta(spark, path, hashed=True).select(basename("path").alias("file"), F.col("sha1").alias("sha1_local"))


def write_files(df: DataFrame, root: str, name: str = "name", content: str = "content") -> int:
    """Write one file per row (binary ``content``) below ``root`` and return how many. A retried task writes the same files again; names must be
    distinct. A null content is an empty file."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = filesystem(root)
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                at = f"{base}/{path}"
                system.create_dir(at.rpartition("/")[0], recursive=True)
                with system.open_output_stream(at) as f:
                    f.write(raw.as_buffer() if raw.is_valid else b"")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    rows = df.select(F.col(name).alias("name"), F.col(content).cast("binary").alias("content"))
    return rows.mapInArrow(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
