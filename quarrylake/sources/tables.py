"""Keyed parquet tables without a transactional table format.

``VersionedTable`` writes each new state next to the old one. A version counts
once Spark's own ``_SUCCESS`` marker is there, so readers see the old state or the
new one, and a failed write is simply written again.

``PartitionedTable`` replaces only the partitions a merge touches, ``BucketedTable`` only the
buckets of its keys: what changes is written aside first and then taken in by Spark's dynamic
partition overwrite; a change that was cut off is finished by the next one.

All allow one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarrylake.operators.key_filter import FILTER_COLUMNS, key_filters, meeting
from quarrylake.operators.latest import keep_latest
from quarrylake.operators.upsert import upsert

SUCCESS = "_SUCCESS"


class Folders:
    """The few file-system calls a table needs, on whatever file system Spark uses."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._path(path))]

    def full(self, path: str) -> str:
        """The path as listings give it."""
        return self._fs.makeQualified(self._path(path)).toString()

    def bytes(self, path: str) -> int:
        return self._fs.getContentSummary(self._path(path)).getLength()

    def drop(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, path: str, to: str) -> None:
        """Rename a folder; the one it comes to lie in is made."""
        self._fs.mkdirs(self._path(to).getParent())
        if not self._fs.rename(self._path(path), self._path(to)):
            raise OSError(f"cannot rename {path} to {to}")


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.folders = Folders(spark, self.path)

    def _folder(self, version: int) -> str:
        return f"{self.path}/v={version:08d}"

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        found = sorted(
            int(name[2:]) for name in self.folders.names(self.path) if name.startswith("v=")
        )
        return [v for v in found if self.folders.exists(f"{self._folder(v)}/{SUCCESS}")]

    def read(self, version: int | None = None) -> DataFrame:
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"no complete version under {self.path}")
        return self.spark.read.parquet(self._folder(version or known[-1]))

    def exists(self) -> bool:
        return bool(self.versions())

    def write(self, df: DataFrame) -> int:
        """Write the next version; it may be computed from the current one."""
        version = max(self.versions(), default=0) + 1
        df.write.mode("overwrite").parquet(self._folder(version))
        return version

    def merge(self, source: DataFrame, keys: list[str], version_column: str) -> int:
        source = keep_latest(source, keys, [version_column])
        if not self.exists():
            return self.write(source)
        return self.write(upsert(self.read(), source, keys, version_column))

    def forget(self, keep: int = 2) -> None:
        """Remove all but the last ``keep`` complete versions."""
        for version in self.versions()[:-keep]:
            self.folders.drop(self._folder(version))


class PartitionedTable:
    """Rows under one folder per value of a partition column.

    A change writes the new rows of the touched partitions aside, then Spark's dynamic
    partition overwrite takes them into the table. What is completely written aside counts:
    a change that was cut off while it was taken over is taken over again by the next one.

    Next to the rows lies a key filter of every partition (see ``key_filters``), so a merge
    knows which partitions can hold its keys without reading the table's keys.

    Many small changes come in by ``put``: each is a set of its own that is read together with the
    partitions, and the sets are merged into these once they are as large as the table.
    """

    def __init__(self, spark: SparkSession, path: str, partition: str, schema: str | None = None):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition
        self._schema = schema
        self.folders = Folders(spark, self.path)
        self._staged, self._filters = f"{self.path}/_staged", f"{self.path}/_keys"
        self._pending, self._pending_of = f"{self.path}/_pending", f"{self.path}/_pending_of"

    def exists(self) -> bool:
        return any(name.startswith(f"{self.partition}=") for name in self.folders.names(self.path))

    def read(self) -> DataFrame:
        """The rows as they are with all that was put."""
        waiting = self._waiting()
        if not waiting:
            return self._rows()
        source, keys, version_column = self._put_rows(waiting)
        return upsert(self._rows(), source, keys, version_column) if self._schema or self.exists() else source

    def _rows(self) -> DataFrame:
        """The rows; columns that older files lack are NULL.

        With a given schema no file is opened to plan the read; without one every
        file's columns are looked up.
        """
        if self._schema:
            return self.spark.read.schema(self._schema).parquet(self.path)
        return self.spark.read.option("mergeSchema", "true").parquet(self.path)

    def partitions(self) -> DataFrame:
        return self.read().select(self.partition).distinct().orderBy(self.partition)

    def write(self, df: DataFrame) -> None:
        """Replace the whole table, its key filters included."""
        self.folders.drop(self._staged)
        df.write.parquet(f"{self._staged}/rows")
        for name in self.folders.names(self.path):
            if name.startswith(f"{self.partition}=") or name.startswith("_keys"):
                self.folders.drop(f"{self.path}/{name}")
        self._save(self.spark.read.schema(df.schema).parquet(f"{self._staged}/rows"))
        self.folders.drop(self._staged)
        self.folders.drop(self._pending)

    def put(self, source: DataFrame, keys: list[str], version_column: str) -> None:
        """Upsert as ``merge`` does, for many small changes: the partitions take it in later.

        The source becomes a set next to the partitions, one rename makes it count, and ``read`` sees it from then on.
        Sets are merged into the partitions together once they hold as many bytes as those, or by ``settle``. So n
        changes rewrite the table about log n times instead of n times. A source with a row without key or
        version is merged at once, as what such a row does depends on what came before it.
        """
        latest = keep_latest(source, keys, [version_column])
        about, waiting = (latest.schema.json(), ",".join(keys), version_column), self._waiting()
        if waiting and self._put_about() != about:
            self.settle()
            waiting = []
        incoming, counts, odd = f"{self.path}/_incoming", Observation(), F.col(version_column).isNull()
        for name in keys:
            odd = odd | F.col(name).isNull()
        latest.observe(counts, F.count_if(odd).alias("odd"), F.count("*").alias("rows")).write.mode("overwrite").parquet(incoming)
        if counts.get["odd"]:
            self.merge(self.spark.read.schema(latest.schema).parquet(incoming), keys, version_column)
            self.folders.drop(incoming)
        elif counts.get["rows"]:
            if not waiting:
                self.folders.drop(self._pending)
                self.spark.createDataFrame([about], _PUT_ABOUT).coalesce(1).write.mode("overwrite").parquet(self._pending_of)
            self.folders.move(incoming, f"{self._pending}/{_SET}={max(waiting, default=0) + 1}")
            if self.folders.bytes(self._pending) >= max(self._bytes(), _FEW_BYTES):
                self.settle()

    def settle(self) -> None:
        """Merge all that was put into the partitions; may be cut off and repeated."""
        self._finish()
        waiting = self._waiting()
        if waiting:
            self._merge(*self._put_rows(waiting))
            self.folders.drop(self._pending)

    def _waiting(self) -> list[int]:
        """The numbers of the sets that no merge has taken into the partitions."""
        return sorted(int(name.split("=")[1]) for name in self.folders.names(self._pending) if name.startswith(f"{_SET}="))

    def _put_about(self) -> tuple[str, str, str]:
        return tuple(self.spark.read.schema(_PUT_ABOUT).parquet(self._pending_of).first())

    def _put_rows(self, waiting: list[int]) -> tuple[DataFrame, list[str], str]:
        """What the sets come to, a row per key: the newest, of equal ones the first put, as if each had been merged."""
        columns, names, version_column = self._put_about()
        schema = StructType.fromJson(json.loads(columns)).add(_SET, "integer")
        sets = self.spark.read.schema(schema).option("basePath", self._pending)
        rows = sets.parquet(*[f"{self._pending}/{_SET}={number}" for number in waiting]).withColumn(_SET, -F.col(_SET))
        keys = names.split(",")
        return keep_latest(rows, keys, [version_column, _SET]).drop(_SET), keys, version_column

    def _bytes(self) -> int:
        """Bytes of the partitions."""
        hidden = [name for name in self.folders.names(self.path) if name.startswith("_")]
        return self.folders.bytes(self.path) - sum(self.folders.bytes(f"{self.path}/{name}") for name in hidden)

    def merge(self, source: DataFrame, keys: list[str], version_column: str) -> None:
        """Upsert; only partitions that hold a changed key, old or new, are rewritten.

        The source is written aside once. Key filters name the partitions that may hold one of
        its keys; of those alone the keys are read, and those with a real match are rewritten,
        together with the partitions of the source's rows. The list of partitions is as small as
        the table's folder list, which the driver holds anyway. What was put before is merged first.
        """
        self.settle()
        self._merge(source, keys, version_column)

    def _merge(self, source: DataFrame, keys: list[str], version_column: str) -> None:
        source = keep_latest(source, keys, [version_column])
        if not self.exists():
            self.write(source)
            return
        self.folders.drop(self._staged)
        incoming = f"{self._staged}/source"
        source.write.parquet(incoming)
        source = self.spark.read.schema(source.schema).parquet(incoming)
        own = [row[0] for row in source.select(self.partition).distinct().collect()]
        rows = self._rows()  # its files are listed once
        held = self._holding(rows, source, keys)
        touched = list({*own, *(row[0] for row in held.collect())})
        if touched:
            self._replace(rows, touched, lambda old: upsert(old, source, keys, version_column), keys)
        else:
            self.folders.drop(self._staged)

    def holding(self, source: DataFrame, keys: list[str]) -> DataFrame:
        """The partitions that hold a key of ``source``; reads keys where the filters cannot exclude one."""
        self.settle()
        return self._holding(self._rows(), source, keys)

    def _holding(self, rows: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
        maybe = _is_one_of(self.partition, self._candidates(rows, source, keys))
        known = rows.where(maybe).select(*keys, self.partition)
        return known.join(source.select(*keys), keys, "left_semi").select(self.partition).distinct()

    def _candidates(self, rows: DataFrame, source: DataFrame, keys: list[str]) -> list:
        if self._filtered_keys() != list(keys):
            self.folders.drop(self._filters)
            self._write_filters(rows, keys)
        return [row[0] for row in meeting(self._stored_filters(rows), source, keys, self.partition).collect()]

    def _stored_filters(self, rows: DataFrame) -> DataFrame:
        kind = rows.schema[self.partition].dataType.simpleString()
        return self.spark.read.schema(f"`{self.partition}` {kind}, {FILTER_COLUMNS}, part int").parquet(self._filters)

    def _filtered_keys(self) -> list[str]:
        """The key columns of the stored filters; none if they are not complete."""
        if not self.folders.exists(f"{self.path}/_keys_of/{SUCCESS}"):
            return []
        return self.spark.read.schema("keys string").parquet(f"{self.path}/_keys_of").first()["keys"].split(",")

    def _write_filters(self, rows: DataFrame, keys: list[str]) -> None:
        """Replace the filters of the partitions in ``rows``.

        Filters lie in a few folders by hash of their partition. They are not complete while some
        are written: cut off, they are built anew by the next merge.
        """
        self.folders.drop(f"{self.path}/_keys_of")
        part = F.pmod(F.xxhash64(F.col(self.partition).cast("string")), F.lit(_FILTER_PARTS)).cast("int")
        filters = key_filters(rows, keys, self.partition).withColumn("part", part)
        if self.folders.exists(self._filters):
            new = rows.select(self.partition).distinct()
            parts = filters.select("part").distinct()
            stored = self._stored_filters(rows).join(parts, "part", "left_semi")
            same = stored[self.partition].eqNullSafe(new[self.partition])
            filters = filters.unionByName(stored.join(new, same, "left_anti"))
        (
            filters.hint("rebalance", F.col("part"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("part")
            .parquet(self._filters)
        )
        complete = self.spark.createDataFrame([(",".join(keys),)], "keys string")
        complete.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_keys_of")

    def rewrite(
        self, days: list, change: Callable[[DataFrame], DataFrame], arranged: bool = False
    ) -> None:
        """Replace the given partitions by ``change`` of their rows.

        For backfills: give a chunk of partitions at a time and repeat a chunk that
        failed. ``change`` must leave the partition column and the keys as they are.
        ``arranged`` says that it sorted the rows by the partition column first, and as they
        shall lie in the files.
        """
        self.settle()
        self.folders.drop(self._staged)
        if days:
            rows = self._rows()
            self._check_known(rows, [day for day in days if day is not None])
            self._replace(rows, list(days), change, None, arranged)

    def _check_known(self, rows: DataFrame, values: list) -> None:
        if values:
            known = rows.where(F.col(self.partition).isin(values)).select(self.partition).distinct()
            asked = self.spark.createDataFrame([(value,) for value in values], ["value"])
            unknown = asked.join(known, asked["value"] == known[self.partition], "left_anti").collect()
            if unknown:
                raise ValueError(f"no such partitions: {[row['value'] for row in unknown]}")

    def _replace(
        self, rows: DataFrame, values: list, change: Callable[[DataFrame], DataFrame], keys: list[str] | None, arranged: bool = False
    ) -> None:
        """Write the changed rows of the partitions aside and take them in.

        A change that only arranges the rows is made while they are taken in.
        """
        old = rows.where(_is_one_of(self.partition, values))
        new = old if arranged else change(old)
        new.write.parquet(f"{self._staged}/rows")
        staged = self.spark.read.schema(new.schema).parquet(f"{self._staged}/rows").select(self.partition).distinct()
        left = [row[0] for row in staged.collect()]
        if {type(value) for value in values} <= {type(None), *map(type, left)}:  # else compare as Spark does
            old = rows.where(_is_one_of(self.partition, [value for value in values if value not in left]))
        folder = F.regexp_extract("_metadata.file_path", "([^/]+)/[^/]+$", 1)
        before = old.select(folder.alias("folder"), F.col(self.partition).alias("value")).distinct()
        emptied = before.join(staged, before["value"].eqNullSafe(staged[self.partition]), "left_anti").select("folder")
        emptied.coalesce(1).write.parquet(f"{self._staged}/emptied")
        about = self.spark.createDataFrame([(new.schema.json(), ",".join(keys or []))], _ABOUT)
        about.coalesce(1).write.parquet(f"{self._staged}/about")  # from here on the change counts
        self._finish(change if arranged else None)

    def _save(self, rows: DataFrame, arranged: bool = False) -> None:
        """Overwrite the partitions of staged ``rows``.

        Each partition's rows come into few files. A large partition is split at run time; few
        rows for many partitions are dealt to several tasks, as they have many files to open.
        """
        if arranged:
            pass
        elif self.folders.bytes(f"{self._staged}/rows") < _FEW_BYTES:
            rows = rows.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.partition)
        else:
            rows = rows.hint("rebalance", F.col(self.partition))
        writer = rows.write.partitionBy(self.partition).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def _finish(self, arrange: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Take what is completely staged into the table; may be cut off and repeated.

        The filters go first: one that knows a key too many only costs a look at its partition.
        Partitions whose rows all went elsewhere have nothing to be overwritten with and are removed.
        """
        if not self.folders.exists(f"{self._staged}/about/{SUCCESS}"):
            return
        [about] = self.spark.read.schema(_ABOUT).parquet(f"{self._staged}/about").collect()
        rows = self.spark.read.schema(StructType.fromJson(json.loads(about.columns))).parquet(f"{self._staged}/rows")
        if about["keys"]:
            self._write_filters(rows, about["keys"].split(","))
        self._save(arrange(rows) if arrange else rows, arrange is not None)
        for row in self.spark.read.schema("folder string").parquet(f"{self._staged}/emptied").collect():
            self.folders.drop(f"{self.path}/{unquote(row.folder)}")
        self.folders.drop(self._staged)


class BucketedTable(PartitionedTable):
    """A keyed table dealt to a fixed number of buckets by hash of its key.

    A key never leaves its bucket, so a merge knows the buckets it touches by its own rows and
    rewrites those alone. Rows without a key are dealt by their content.
    """

    BUCKET = "_bucket"

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 16, schema: str | None = None):
        super().__init__(spark, path, self.BUCKET, schema and f"{schema}, `{self.BUCKET}` int")
        self.keys, self.buckets = list(keys), buckets

    def read(self) -> DataFrame:
        return self._rows().drop(self.BUCKET)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        keyless = F.lit(False)
        for name in self.keys:
            keyless = keyless | F.col(name).isNull()
        # numbers of any width and texts alike hash by their text
        by_key = F.xxhash64(*[F.col(name).cast("string") for name in self.keys])
        by_row = F.xxhash64(*[name for name in rows.columns if name != self.BUCKET])
        bucket = F.pmod(F.when(keyless, by_row).otherwise(by_key), F.lit(self.buckets))
        return rows.withColumn(self.BUCKET, bucket.cast("int"))

    def write(self, df: DataFrame) -> None:
        super().write(self._dealt(df))

    def merge(self, source: DataFrame, keys: list[str], version_column: str) -> None:
        if list(keys) != self.keys:
            raise ValueError(f"the table is dealt by {self.keys}, not by {keys}")
        self._finish()
        source = keep_latest(source, keys, [version_column])
        if not self.exists():
            self.write(source)
            return
        self.folders.drop(self._staged)
        self._dealt(source).write.parquet(f"{self._staged}/source")
        source = self.spark.read.parquet(f"{self._staged}/source")
        touched = [row[0] for row in source.select(self.BUCKET).distinct().collect()]
        if not touched:
            self.folders.drop(self._staged)
            return
        self._replace(self._rows(), touched, lambda old: upsert(old, source, keys, version_column), None)

    def put(self, source: DataFrame, keys: list[str], version_column: str) -> None:
        self.merge(source, keys, version_column)

    def arrange(self, change: Callable[[DataFrame], DataFrame]) -> None:
        """Rewrite all buckets in the order that ``change`` gives their rows."""
        self._finish()
        self.folders.drop(self._staged)
        if self.exists():
            rows = self._rows()
            buckets = [row[0] for row in rows.select(self.BUCKET).distinct().collect()]
            self._replace(rows, buckets, change, None, arranged=True)


_ABOUT = "columns string, keys string"
_SET, _PUT_ABOUT = "_set", "columns string, keys string, version string"
_FILTER_PARTS = 16
#: Less than a task's usual share in all.
_FEW_BYTES = 64 << 20


def _is_one_of(name: str, values: list):
    known = F.col(name).isin([v for v in values if v is not None])
    return known | F.col(name).isNull() if None in values else known


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file below a folder: its folder relative to ``path``, path, length and time.

    A listing only: no file is opened, and hidden folders are left out. A folder without files gives no rows.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length", "modificationTime")  # without the content
    )
    root = Folders(spark, path).full(path).split(":", 1)[-1].lstrip("/")
    # schemes may come with one slash or three
    below = F.regexp_replace("path", "^[a-z0-9]+:/+", "")
    inner = F.substr(below, F.lit(len(root) + 2))
    return files.select(F.regexp_replace(inner, "/?[^/]+$", "").alias("folder"), "path", "length", "modificationTime")


def folder_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(folder, files, size_bytes, smallest, largest) of every folder with data files below ``path``."""
    return listed_files(spark, path).groupBy("folder").agg(
        F.count("*").alias("files"),
        F.sum("length").alias("size_bytes"),
        F.min("length").alias("smallest"),
        F.max("length").alias("largest"),
    )


def table_files(df: DataFrame, table_name: str) -> DataFrame:
    """One row: number of files and bytes behind a file-based frame."""
    files = df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(
        F.max("file_size").alias("size"), F.count("*").alias("rows")
    )
    return files.agg(
        F.lit(table_name).alias("table_name"),
        F.count("*").alias("files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("size_bytes"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
    )
