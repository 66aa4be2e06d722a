"""Raw files found and read by the executors.

A folder tree is listed level by level: the folders of one level are rows of a table, dealt to
all tasks, and each task lists its own. So a tree of any size is listed in as many jobs as it has
levels, and the driver holds no name but the root's. The list is a table of paths and sizes.
Reading packs files into tasks by their bytes, so that a task reads many small files or few
large ones.

Paths are opened through Arrow's file systems (local and shared folders, HDFS, S3, GCS). For a
store that only Spark reaches, ``scans.read_raw_files`` lists on the driver.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.session import scratch_path

TASK_BYTES = 128 << 20
TASK_FILES = 20_000
SCHEMES = ("file", "hdfs", "s3", "gs")
BATCH_BYTES = 16 << 20
FILES = "path STRING, length BIGINT, modified TIMESTAMP"
_FOUND = f"{FILES}, folder BOOLEAN"
_CONTENT = "path STRING, content BINARY"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system that Spark uses for it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(target).toString()


def plain(uri: str) -> str:
    """A qualified path as the readers give it: local ones without a scheme."""
    return re.sub("^file:/+", "/", uri)


def opened(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path with a scheme, and the path in it. Names in such paths are
    plain, not escaped, so only scheme and host go through Arrow's parser."""
    scheme, _, rest = uri.partition(":")
    host, _, path = rest[2:].partition("/") if rest.startswith("//") else ("", "", rest[1:])
    system, base = pa.fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return system, f"{base.rstrip('/')}/{path}"


def opens(spark: SparkSession, root: str) -> bool:
    """Whether ``root`` is a folder of a file system that Arrow opens."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getScheme() in SCHEMES and system.exists(target) and system.isDirectory(target)


def _children(folders: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.bool_()]
    for batch in folders:
        for uri in batch.column("path").to_pylist():
            system, base = opened(uri)
            found = system.get_file_info(pa.fs.FileSelector(base, recursive=False))
            rows = [
                (f"{uri.rstrip('/')}/{info.base_name}", info.size or 0, info.mtime,
                 info.type == pa.fs.FileType.Directory)
                for info in found
            ]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["path", "length", "modified", "folder"],
            )


def list_files(spark: SparkSession, root: str, tasks: int | None = None) -> DataFrame:
    """All files under ``root``: ``path``, ``length``, ``modified``. Hidden names (leading
    ``_`` or ``.``) are left out, as Spark does. An empty tree gives an empty table."""
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    level = spark.range(1).select(F.lit(qualified(spark, root)).alias("path"))
    levels = []
    while True:
        path = scratch_path(spark, "listing")
        name = F.element_at(F.split("path", "/"), -1)
        shown = level.mapInArrow(_children, _FOUND).where(~F.substring(name, 1, 1).isin("_", "."))
        shown.write.parquet(path)
        found = spark.read.schema(_FOUND).parquet(path)
        levels.append(found.where(~F.col("folder")).drop("folder"))
        folders = found.where("folder").select("path")
        if folders.isEmpty():
            break
        level = folders.repartition(tasks, "path")
    files = levels[0]
    for more in levels[1:]:
        files = files.unionByName(more)
    return files


def read_listed(files: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Content of listed files: ``path`` (without ``file:``) and ``content``.

    Files are dealt by a hash of their path to as many tasks as their bytes and number ask for;
    batches hold about ``BATCH_BYTES`` or one file.
    """
    total, number = files.agg(F.sum("length"), F.count("*")).first()
    tasks = max(1, ceil((total or 0) / task_bytes), ceil(number / TASK_FILES))

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, data, room = [], [], BATCH_BYTES

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(data, pa.binary())], ["path", "content"]
            )

        for batch in batches:
            for uri in batch.column("path").to_pylist():
                system, name = opened(uri)
                with system.open_input_file(name) as file:
                    data.append(file.read())
                paths.append(uri)
                room -= len(data[-1])
                if room <= 0:
                    yield packed()
                    paths, data, room = [], [], BATCH_BYTES
        if paths:
            yield packed()

    read = files.select("path").repartition(tasks, "path").mapInArrow(contents, _CONTENT)
    return read.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "content")


def write_files(files: DataFrame, root: str) -> str:
    """Land rows (``path`` relative to ``root``, ``content``) as one file each.

    A file appears under its name when it is complete; a task that runs again writes the same
    bytes. Equal paths with different contents leave one of them, so paths should differ.
    """
    spark = files.sparkSession
    base = qualified(spark, root)

    def land(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(base)
        made = set()
        for batch in batches:
            for path, content in zip(
                batch.column("path").to_pylist(), batch.column("content"), strict=True
            ):
                target = f"{top}/{path.lstrip('/')}"
                folder = target.rsplit("/", 1)[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                part = f"{folder}/.{uuid.uuid4().hex}"
                with system.open_output_stream(part, compression=None) as out:
                    out.write(content.as_buffer() if content.is_valid else b"")
                system.move(part, target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    files.select("path", "content").mapInArrow(land, "n BIGINT").agg(F.sum("n")).collect()
    return root
