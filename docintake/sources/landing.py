"""Files in the landing zones and recorded responses, as fact tables.

Folders are listed level by level in Spark tasks, and files are read in tasks that are dealt by
size; neither names nor contents pass through the driver. Contents are read once, at the
scan, and reduced there to hash, length and what the content shows of its type.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docintake.functions.headers import headers_from_map
from docintake.functions.mimetypes import sniff
from docintake.schema import HEADERS
from docintake.session import cut, prepare_python

TASK_BYTES = 64 << 20  # of files that one task reads
TASK_FILES = 2_000
BATCH_BYTES = 4 << 20


def content_facts(content: Column) -> list[Column]:
    return [
        F.octet_length(content).cast("bigint").alias("length"),
        F.md5(content).alias("md5"),
        sniff(content).alias("kind"),
    ]


def _file_system(root: str):
    from pyarrow import fs

    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root[len("file:") :].lstrip("/")
    if "://" not in root:
        return fs.LocalFileSystem(), root
    return fs.FileSystem.from_uri(root)


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


_LISTED = "path string, is_folder boolean, length bigint, modified bigint"


def list_files(spark: SparkSession, root: str, zone: str = "") -> DataFrame:
    """``path`` (below the root), ``length`` and ``mtime`` of every file below ``root/zone``.

    Each round lists all folders of one level, a task for each few of them; the driver sees
    only whether there are more. Hidden files, as Spark's own readers leave them out, are not
    listed. A zone that does not exist has no files.
    """
    prepare_python(spark)
    root = root.rstrip("/")

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = _file_system(root)
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                selector = fs.FileSelector(f"{base}/{folder}".rstrip("/"), allow_not_found=True)
                found = [i for i in system.get_file_info(selector) if not _hidden(i.base_name)]
                for first in range(0, len(found), 10_000):
                    some = found[first : first + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([f"{folder}/{i.base_name}".lstrip("/") for i in some], pa.string()),
                            pa.array([i.type == fs.FileType.Directory for i in some], pa.bool_()),
                            pa.array([i.size for i in some], pa.int64()),
                            pa.array([(i.mtime_ns or 0) // 1_000_000 for i in some], pa.int64()),
                        ],
                        ["path", "is_folder", "length", "modified"],
                    )

    level = spark.createDataFrame([(zone.strip("/"),)], "path string")
    levels = []
    while True:
        listed = cut(level.mapInArrow(children, _LISTED))
        levels.append(listed.where("NOT is_folder"))
        folders = listed.where("is_folder").select("path")
        n = folders.count()
        if not n:
            break
        level = folders.repartition(max(1, min(n, 4 * spark.sparkContext.defaultParallelism)))
    files = levels[0]
    for other in levels[1:]:
        files = files.unionByName(other)
    mtime = F.timestamp_millis("modified").cast("timestamp_ntz")
    return files.select("path", "length", mtime.alias("mtime"))


#: What Spark's writers escape in the name of a folder.
_ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")
_NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def place_texts(texts: DataFrame, folder: str) -> None:
    """Write the ``value`` rows of each ``file`` as lines of ``folder/file=<file>/text.txt``.

    Folders are named as by Spark's ``partitionBy``, but the tasks write each file in its place at
    once. A task that is run again writes the same files over its own.
    """
    spark = texts.sparkSession
    prepare_python(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)
        current, stream, written = None, None, 0
        try:
            for batch in batches:
                for file, value in zip(batch.column("file"), batch.column("value")):
                    name = file.as_py()
                    if name != current:
                        if stream is not None:
                            stream.close()
                        escaped = _ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", name) or _NO_NAME
                        system.create_dir(f"{base}/file={escaped}", recursive=True)
                        stream = system.open_output_stream(f"{base}/file={escaped}/text.txt")
                        current, written = name, written + 1
                    stream.write(value.as_buffer())
                    stream.write(b"\n")
        finally:
            if stream is not None:
                stream.close()
        yield pa.RecordBatch.from_pydict({"written": pa.array([written], pa.int64())})

    tasks = max(spark.sparkContext.defaultParallelism, -(-texts.count() // TASK_FILES))
    dealt = texts.select("file", "value").repartition(tasks, "file").sortWithinPartitions("file")
    dealt.mapInArrow(write, "written bigint").agg(F.sum("written")).first()


def scan_landing_files(spark: SparkSession, root: str, zone: str = "") -> DataFrame:
    """Facts of every file below ``root/zone``, empty ones too; paths are relative to the root."""
    files = list_files(spark, root, zone)
    n, size = files.agg(F.count("*"), F.sum("length")).first()
    tasks = max(1, -(-(size or 0) // TASK_BYTES), -(-n // TASK_FILES))
    root = root.rstrip("/")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(root)

        def batch_of(rows):
            paths, times, contents = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(times, pa.timestamp("us")), pa.array(contents, pa.binary())],
                ["path", "mtime", "content"],
            )

        held, size = [], 0
        for batch in batches:
            for path, mtime in zip(batch.column("path").to_pylist(), batch.column("mtime").to_pylist()):
                with system.open_input_stream(f"{base}/{path}") as stream:
                    content = stream.read()
                held.append((path, mtime, content))
                size += len(content)
                if size > BATCH_BYTES:
                    yield batch_of(held)
                    held, size = [], 0
        if held:
            yield batch_of(held)

    contents = files.select("path", "mtime").repartition(tasks, "path").mapInArrow(
        read, "path string, mtime timestamp_ntz, content binary"
    )
    return contents.select("path", *content_facts(F.col("content")), "mtime").select(
        "path", "length", "md5", "mtime", "kind"
    )


def capture_facts(captures: DataFrame) -> DataFrame:
    """Fact rows of a crawl log (uri, status, headers as map or entries, content, fetched)."""
    headers = F.col("headers")
    if captures.schema["headers"].dataType.typeName() == "map":
        headers = headers_from_map(headers)
    location = F.filter(headers, lambda h: F.lower(h["name"]) == "location")
    return captures.select(
        "uri",
        F.col("status").cast("int").alias("status"),
        F.get(F.get(location, F.lit(0))["values"], F.lit(0)).alias("location"),
        headers.cast(HEADERS).alias("headers"),
        *content_facts(F.col("content")),
        F.col("fetched").cast("timestamp_ntz").alias("fetched"),
    )
