"""Reading and writing tables, by catalog name or below a shared root path."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.operators.merge import upsert
from tallyward.sources.contracts import ContractError, conform
from tallyward.sources.scratch import Scratch
from tallyward.sources.versions import DATA, WRITTEN, Version, VersionLog

# Where a merged table keeps the hash of its keys.
BUCKET = "_bucket"

LAYERS = ("bronze", "silver", "gold", "monitoring", "quality", "models")


@dataclass(frozen=True)
class TableStore:
    """Tables named ``layer.table``.

    With ``root`` set they are folders ``root/layer/table`` on shared storage, otherwise tables of
    the session catalog. ``fmt`` is any data source Spark has on its class path.

    A table in a folder has versions. Every write adds one, whole or not at all, and leaves the data
    of the ones before alone, so readers and a writer that is lost disturb nobody. The last ``keep``
    versions stay; data that a lost writer left are in no version. The format "delta" has versions of
    its own. ``codec`` compresses files of a versioned folder; without it the session's does.
    """

    spark: SparkSession
    root: str | None = None
    fmt: str = "parquet"
    keep: int = 2
    codec: str | None = None

    def location(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def sources(self, names: Sequence[str]) -> dict[str, DataFrame | None]:
        """The named tables, None for those that do not exist."""
        return {name: self.read(name) if self.exists(name) else None for name in names}

    def create_layers(self, layers: Sequence[str] = LAYERS) -> None:
        """Create the databases; nothing to do for path storage."""
        if self.root is None:
            for layer in layers:
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")

    @property
    def versioned(self) -> bool:
        return self.root is not None and self.fmt != "delta"

    def log(self, name: str) -> VersionLog:
        return VersionLog(self.spark, self.location(name))

    def exists(self, name: str) -> bool:
        """Whether the table is there; a folder that cannot be read is an error, not an absence."""
        if self.root is None:
            return self.spark.catalog.tableExists(name)
        if self.versioned:
            return bool(self.log(name).numbers())
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.location(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table or published view, with the schema it was written with; the last version of it."""
        if self.root is None:
            return self.spark.table(name)
        if not self.versioned:
            return self.spark.read.format(self.fmt).load(self.location(name))
        log = self.log(name)
        found = log.read(version) if version else log.latest()
        if found is None:
            raise ContractError(f"{name}: no such table")
        if found.view:
            shown = found.view
            return self.read(shown["source"]).filter(shown["where"]).select(shown["columns"])
        return self._load(name, found).select(_columns(found.struct()))

    def _load(self, name: str, version: Version) -> DataFrame:
        """The rows of a version's folders, with the columns that its folders name."""
        schema = version.struct().add(WRITTEN, T.StringType())
        if version.buckets:
            schema = schema.add(BUCKET, T.IntegerType())
        if not version.parts:
            return self.spark.createDataFrame([], schema)
        here = self.location(name)
        reader = self.spark.read.format(self.fmt).schema(schema)
        return reader.option("basePath", f"{here}/{DATA}").load([f"{here}/{p}" for p in version.parts])

    def _write(
        self,
        df: DataFrame,
        name: str,
        mode: str,
        partition_by: Sequence[str],
        batch: str | None = None,
    ) -> None:
        if batch is not None and not self.versioned:
            raise ContractError("batches are known by name in versioned folders alone")
        if not self.versioned:
            writer = df.write.format(self.fmt).mode(mode)
            if self.fmt == "delta" and mode == "overwrite":
                writer = writer.option("overwriteSchema", "true")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            if self.root is None:
                writer.saveAsTable(name)
            else:
                writer.save(self.location(name))
            return
        log, part, schema = self.log(name), None, _nullable(df.schema).json()
        while True:
            before = log.latest() or Version()
            if mode == "append" and batch is not None and batch in before.batches:
                return
            if part is None:
                part = self._write_part(df, name, partition_by)
            after = before.next(schema=schema, parts=(part,), batches=(), keys=(), buckets=0, view=None)
            if mode == "append" and before.parts:
                if before.buckets:
                    raise ContractError(f"{name}: rows of a merged table come by merge")
                after = before.next(parts=(*before.parts, part))
            if mode == "append":
                after = replace(after, batches=(*before.batches, *([batch] if batch else [])))
            if log.commit(after):
                return log.forget(self.keep)

    def _write_part(self, df: DataFrame, name: str, partition_by: Sequence[str]) -> str:
        """Write rows to a folder of their own below the table's."""
        part = f"{DATA}/{WRITTEN}={uuid.uuid4().hex}"
        writer = df.write.format(self.fmt)
        if self.codec:
            writer = writer.option("compression", self.codec)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(f"{self.location(name)}/{part}")
        return part

    def overwrite(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace the table, schema included."""
        self._write(df, name, "overwrite", partition_by)
        return self.read(name)

    def overwrite_checked(
        self, df: DataFrame, name: str, expected: T.StructType | None = None
    ) -> DataFrame:
        """Replace the rows and keep the schema: that of ``expected``, else of the present table."""
        if expected is None and self.exists(name):
            expected = self.read(name).schema
        self._write(conform(df, expected) if expected else df, name, "overwrite", ())
        return self.read(name)

    def append(
        self,
        df: DataFrame,
        name: str,
        expected: T.StructType | None = None,
        batch: str | None = None,
    ) -> DataFrame:
        """Add rows; columns are matched by name and must be those of the table.

        Rows of a named ``batch`` come in once: a table that has the batch stays as it is.
        """
        if expected is None and self.exists(name):
            expected = self.read(name).schema
        self._write(conform(df, expected) if expected else df, name, "append", (), batch)
        return self.read(name)

    def merge(
        self,
        changes: DataFrame,
        name: str,
        keys: Sequence[str],
        delete: Column | None = None,
        order: Sequence[str] = (),
        batch: str | None = None,
        buckets: int = 64,
    ) -> DataFrame:
        """Replace, add and remove rows by key; see `upsert`.

        The table is cut into ``buckets`` by the hash of its keys when the first batch creates it; a
        merge reads and rewrites the buckets that its changes fall into and no others. Buckets are
        rewritten by as many tasks as their size asks for. A named ``batch`` is merged once. A
        ``ContractError`` says that another writer was faster; nothing has happened then.
        """
        if not self.versioned:
            raise ContractError("merge needs a versioned folder")
        log = self.log(name)
        before = log.latest()
        if before and batch is not None and batch in before.batches:
            return self.read(name)
        if before:
            if before.keys != tuple(keys):
                raise ContractError(f"{name}: merged by {before.keys}, not by {tuple(keys)}")
            schema, buckets = before.struct(), before.buckets
        else:
            schema = _nullable(changes.schema)
            before = Version(schema=schema.json(), keys=tuple(keys), buckets=buckets)
        wanted = {f.name: f.dataType for f in schema.fields}
        found = {f.name: f.dataType for f in changes.schema.fields}
        wrong = [c for c, kind in wanted.items() if found.get(c) != kind]
        if wrong:
            raise ContractError(f"{name}: missing or of another type: {', '.join(wrong)}")
        bucket = F.pmod(F.xxhash64(*[f"`{k}`" for k in keys]), F.lit(buckets)).cast("int")
        # read for its buckets, its keys and its rows
        changes = Scratch.create(self.spark).keep(changes, "changes")
        touched = {r[0] for r in changes.select(bucket).distinct().collect()}
        old = [p for p in before.parts if _bucket_of(p) in touched]
        rows = self._load(name, replace(before, parts=tuple(old)))
        if not touched:
            rows, old = rows.limit(0), []
        merged = upsert(rows.select(_columns(schema)), changes, keys, delete, order)
        part = self._write_part(
            merged.withColumn(BUCKET, bucket).hint("rebalance", BUCKET), name, [BUCKET]
        )
        new = [f"{part}/{folder}" for folder in log.folders(part)]
        after = before.next(
            parts=(*[p for p in before.parts if p not in old], *new),
            batches=(*before.batches, *([batch] if batch else [])),
        )
        if not log.commit(after):
            raise ContractError(f"{name}: changed by another writer since version {before.number}")
        log.forget(self.keep)
        return self.read(name)

    def publish_view(self, name: str, source: str, where: str, columns: Sequence[str]) -> None:
        """A named view over part of a stored table; in a path store a note of what it shows."""
        if self.root is None:
            picked = ", ".join(f"`{c}`" for c in columns)
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {name} AS SELECT {picked} FROM {source} WHERE {where}"
            )
            return
        log, shown = self.log(name), {"source": source, "where": where, "columns": list(columns)}
        while not log.commit((log.latest() or Version()).next(view=shown, parts=(), schema=None)):
            pass
        log.forget(self.keep)


def _columns(schema: T.StructType) -> list[Column]:
    return [F.col(f"`{c}`") for c in schema.fieldNames()]


def _bucket_of(part: str) -> int:
    """The bucket that a folder of a merged table holds."""
    return int(part.rsplit("=", 1)[1])


def _nullable(schema: T.StructType) -> T.StructType:
    """The schema as files give it back: they promise no column without nulls."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder on the storage all executors share, removed when the session ends."""
    return Scratch.create(spark).folder


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def source_access(
    spark: SparkSession, tables: Mapping[str, DataFrame | None], sample: int = 5
) -> DataFrame:
    """Read a few rows of every source: (table_name, present, rows_read); None means absent."""

    def report(name: str, df: DataFrame | None) -> DataFrame:
        rows = spark.range(0) if df is None else df.limit(sample)
        return rows.agg(F.count("*").alias("rows_read")).select(
            F.lit(name).alias("table_name"), F.lit(df is not None).alias("present"), "rows_read"
        )

    return _union([report(name, df) for name, df in tables.items()])


def source_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every source: (table_name, row_count)."""
    return _union(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def preview(df: DataFrame, rows: int, order_by: Sequence[str] = ()) -> DataFrame:
    """The first rows; repeatable only when ``order_by`` decides ties."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)
