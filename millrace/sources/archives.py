"""Tar archives of CSV files as a data source, and a writer for them.

``spark.read.format("tar_csv")`` has one partition per archive. An archive is opened as a
stream of the file system that its path names and read from front to back, so its size
doesn't matter; members come as Arrow batches of a bounded number of bytes.
"""

from __future__ import annotations

import fnmatch
import io
import posixpath
import tarfile
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.csv as pc
import pyarrow.fs as pf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCK_BYTES = 4 << 20


def _open_fs(path: str) -> tuple[pf.FileSystem, str]:
    """File system and path within it; a plain path is a local, or mounted, one."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return pf.LocalFileSystem(), path
    return pf.FileSystem.from_uri(path) if rest.startswith("//") else pf.FileSystem.from_uri(f"{scheme}://{rest}")


def archives(pattern: str) -> list[str]:
    """Files that match ``pattern``, whose last part may have wildcards, or that a folder holds."""
    pattern = pattern.rstrip("/")
    above, name = posixpath.split(pattern)
    if not any(c in name for c in "*?["):
        fs, path = _open_fs(pattern)
        if fs.get_file_info(path).type != pf.FileType.Directory:
            return [pattern]
        above, name = pattern, "*"
    fs, folder = _open_fs(above)
    found = fs.get_file_info(pf.FileSelector(folder, allow_not_found=True))
    names = sorted(f.base_name for f in found if f.is_file)
    return [f"{above}/{n}" for n in names if fnmatch.fnmatch(n, name) and not n.startswith(".")]


class TarCsvReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType) -> None:
        self.pattern, self.members = options["path"], options.get("members", "*.csv")
        self.block = int(options.get("block_bytes", BLOCK_BYTES))
        self.columns = [f.name for f in schema][2:]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in archives(self.pattern)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no archive
            return
        fs, path = _open_fs(partition.value)
        with fs.open_input_stream(path, compression=None) as stream, tarfile.open(fileobj=stream, mode="r|*") as tar:
            for member in tar:
                if member.isfile() and member.size and fnmatch.fnmatch(member.name, self.members):
                    yield from self._rows(partition.value, member.name, tar.extractfile(member))

    def _rows(self, archive: str, name: str, file: io.BufferedIOBase) -> Iterator[pa.RecordBatch]:
        text = {c: pa.string() for c in self.columns}
        convert = pc.ConvertOptions(
            column_types=text, include_columns=self.columns, include_missing_columns=True, null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=True
        )
        reader = pc.open_csv(file, pc.ReadOptions(block_size=self.block), pc.ParseOptions(newlines_in_values=True), convert)
        for batch in reader:
            if batch.num_rows:
                where = [pa.array([x] * batch.num_rows, pa.string()) for x in (archive, name)]
                yield pa.RecordBatch.from_arrays([*where, *batch.columns], names=["archive", "member", *self.columns])


class TarCsv(DataSource):
    """Options: ``path`` (a file, a folder or a pattern) and ``members`` (a pattern of member names)."""

    @classmethod
    def name(cls) -> str:
        return "tar_csv"

    def schema(self) -> str:
        return "archive string, member string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return TarCsvReader(self.options, schema)


def read_tar_csv(spark: SparkSession, path: str, columns: Sequence[str], members: str = "*.csv", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of the CSV members of tar archives, plain or compressed, with archive and member names.

    All columns are text; empty values and columns that a member lacks are null. Members that
    ``members`` leaves out are passed over unparsed. Executors have to reach the path by a file
    system that Arrow knows.
    """
    spark.dataSource.register(TarCsv)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("archive", "member", *columns)])
    return spark.read.format("tar_csv").schema(schema).option("members", members).option("block_bytes", block_bytes).load(path)


def write_tar_csv(df: DataFrame, path: str, archive: str, member: str) -> DataFrame:
    """Write a ``.tar.gz`` per value of ``archive`` with a CSV file per value of ``member``; returns their names and rows.

    An archive is one file, so one task writes it, a member at a time from sorted rows. It appears
    under its name when it is complete, so a task that is tried again leaves no halves behind.
    """
    columns = [c for c in df.columns if c not in (archive, member)]
    text = df.select(*[F.col(c).cast("string").alias(c) for c in (archive, member, *columns)])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _open_fs(path)
        fs.create_dir(folder, recursive=True)
        done: list[tuple[str, int]] = []
        now: list = [None, None, 0]  # archive, member, rows
        part, body, tar, out = "", io.BytesIO(), None, None

        def end_member() -> None:
            nonlocal body
            if tar is not None and body.tell():
                info = tarfile.TarInfo(f"{now[1]}.csv")
                info.size = body.tell()
                body.seek(0)
                tar.addfile(info, body)
            body = io.BytesIO()

        def end_archive() -> None:
            if tar is not None:
                end_member()
                tar.close()
                out.close()
                fs.move(part, f"{folder}/{now[0]}.tar.gz")
                done.append((now[0], now[2]))

        for batch in batches:
            names = list(zip(batch.column(archive).to_pylist(), batch.column(member).to_pylist(), strict=True))
            at = 0
            while at < len(names):
                end = at
                while end < len(names) and names[end] == names[at]:
                    end += 1
                if names[at][0] != now[0] or tar is None:
                    end_archive()
                    now = [names[at][0], None, 0]
                    part = f"{folder}/.{uuid.uuid4().hex}"
                    out = fs.open_output_stream(part, compression=None)
                    tar = tarfile.open(fileobj=out, mode="w|gz")
                if names[at][1] != now[1]:
                    end_member()
                    now[1] = names[at][1]
                rows = pa.table({c: batch.column(c).slice(at, end - at) for c in columns})
                pc.write_csv(rows, body, pc.WriteOptions(include_header=body.tell() == 0))
                now[2] += end - at
                at = end
        end_archive()
        if done:
            yield pa.RecordBatch.from_pydict({"archive": [a for a, _ in done], "rows": [n for _, n in done]})

    ordered = text.where(F.col(archive).isNotNull() & F.col(member).isNotNull()).repartition(archive).sortWithinPartitions(archive, member)
    return ordered.mapInArrow(write, "archive string, rows long")
