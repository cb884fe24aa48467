"""Versioned tables: a full snapshot and the changes committed after it.

A commit writes changed rows and the keys of deleted ones, so a small batch does not
rewrite the catalog. A version counts once its marker is written, after all its tables;
a batch that is replayed finds its marker and writes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

VERSION = StructField("version", LongType())

# The tables of a store and the columns that identify their rows.
TABLE_KEYS = {
    "catalog": ["doc_id"],
    "mappings": ["mapping_id"],
    "flags": ["doc_id", "consumer"],
    "files": ["path"],
    "retries": ["seq"],
}
# commits after a snapshot that a load reads at most, before the next is made
COMPACT_AFTER = 50


def _names(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return [s.getPath().getName() for s in fs.listStatus(path)]


def is_complete(spark: SparkSession, folder: str) -> bool:
    return "_SUCCESS" in _names(spark, folder)


class TableStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[tuple[int, bool]]:
        """Committed versions in order, and whether each is a full snapshot."""
        found = []
        for name in _names(self.spark, f"{self.path}/commits"):
            number, _, kind = name.partition("-")
            if is_complete(self.spark, f"{self.path}/commits/{name}"):
                found.append((int(number), kind == "full"))
        return sorted(found)

    def _mark(self, version: int, kind: str, batch_id: int | None) -> None:
        marker = self.spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id"))
        marker.coalesce(1).write.mode("overwrite").json(
            f"{self.path}/commits/{version:012d}-{kind}"
        )

    def last_batch(self) -> int | None:
        """Largest stream batch that is already part of the store."""
        if not self.versions():
            return None
        commits = self.spark.read.schema("batch_id bigint").json(f"{self.path}/commits/*")
        return commits.agg(F.max("batch_id")).first()[0]

    def commit_full(self, tables: dict[str, DataFrame], batch_id: int | None = None) -> int:
        versions = self.versions()
        version = versions[-1][0] + 1 if versions else 1
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.path}/{name}/full/{version:012d}")
        self._mark(version, "full", batch_id)
        return version

    def commit_changes(
        self,
        changed: dict[str, DataFrame],
        deleted: dict[str, DataFrame] | None = None,
        batch_id: int | None = None,
    ) -> int:
        """Add rows to set (by key) and keys to drop as the next version."""
        version = self.versions()[-1][0] + 1
        for name, df in changed.items():
            df.write.mode("overwrite").parquet(f"{self.path}/{name}/changed/version={version}")
        for name, df in (deleted or {}).items():
            df.select(TABLE_KEYS[name][:1]).write.mode("overwrite").parquet(
                f"{self.path}/{name}/deleted/version={version}"
            )
        self._mark(version, "part", batch_id)
        return version

    def load(self, name: str, version: int | None = None) -> DataFrame:
        """Table as of a version: the snapshot before it and the later changes."""
        usable = [v for v in self.versions() if version is None or v[0] <= version]
        base_version = max(v for v, full in usable if full)
        base = self.spark.read.parquet(f"{self.path}/{name}/full/{base_version:012d}")
        later = [v for v, _ in usable if v > base_version]
        keys = TABLE_KEYS[name]

        def parts(kind: str) -> list[str]:
            folder = f"{self.path}/{name}/{kind}"
            present = set(_names(self.spark, folder))
            return [f"{folder}/version={v}" for v in later if f"version={v}" in present]

        def read(kind: str, schema: StructType) -> DataFrame | None:
            paths = parts(kind)
            if not paths:
                return None
            reader = self.spark.read.option("basePath", f"{self.path}/{name}/{kind}")
            return reader.schema(schema).parquet(*paths)

        changed = read("changed", StructType(base.schema.fields + [VERSION]))
        gone = read("deleted", StructType([base.schema[keys[0]], VERSION]))
        if gone is not None:
            gone = gone.groupBy(keys[0]).agg(F.max("version").alias("gone_at"))
            base = base.join(gone.select(keys[0]), keys[0], "left_anti")
        if changed is None:
            return base
        newest = changed.groupBy(keys).agg(F.max("version").alias("version"))
        live = changed.join(newest, [*keys, "version"], "left_semi")
        if gone is not None:
            live = live.join(gone, keys[0], "left").where(
                "gone_at IS NULL OR gone_at < version"
            )
        columns = [f.name for f in base.schema.fields]
        return (
            base.join(newest.select(keys), keys, "left_anti").select(columns)
            .unionByName(live.select(columns))
        )

    def compact(self, batch_id: int | None = None) -> int:
        """Write a new full snapshot; older files stay for readers of older versions."""
        full = f"{max(v for v, full in self.versions() if full):012d}"
        present = [n for n in TABLE_KEYS if full in _names(self.spark, f"{self.path}/{n}/full")]
        return self.commit_full({name: self.load(name) for name in present}, batch_id)

    def compact_if_long(self) -> None:
        """A new snapshot once loads would have to read many commits."""
        versions = self.versions()
        last = max(i for i, (_, full) in enumerate(versions) if full)
        if len(versions) - last > COMPACT_AFTER:
            self.compact(self.last_batch())


def load_catalog(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return TableStore(spark, path).load("catalog", version)


def load_mappings(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return TableStore(spark, path).load("mappings", version)
