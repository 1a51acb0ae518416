"""Stored tables: Parquet in a folder per layer, optionally in the catalog.

The tables of ``Layers`` are versioned: see ``tallymart.sources.versions``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.session import scratch_path
from tallymart.sources import versions

LAYERS = ("bronze", "silver", "gold", "ref", "audit")
#: folder in which a file stream lists what it has written
STREAM_LOG = "_spark_metadata"


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    only_partitions: bool = False,
    rebalance: bool = False,
    replaces: Sequence[int] = (),
) -> None:
    """Write a folder of Parquet files.

    ``only_partitions`` replaces just the partitions that occur in ``df``, so
    reloading a year twice gives the same table. ``replaces`` names values of
    the single partition column that end up with the rows of ``df`` also if it
    has none for them. ``rebalance`` adds a shuffle that evens out file sizes,
    with large partitions cut in several files. A folder that a stream writes
    takes no other rows, as readers trust the stream's own list of files.
    """
    spark = df.sparkSession
    if (mode == "append" or only_partitions) and file_names(spark, f"{path}/{STREAM_LOG}"):
        raise ValueError(f"{path} is written by a stream")
    if replaces and (not only_partitions or len(partition_by) != 1):
        raise ValueError("replaces needs only_partitions and one partition column")
    folders = [f"{path}/{partition_by[0]}={v}" for v in replaces]
    before = {f: file_names(spark, f) for f in folders}
    if rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    # files carry the id of the job that wrote them: the same names mean old rows
    for folder, names in before.items():
        if names and file_names(spark, folder) == names:
            delete_folder(spark, folder)


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    system, folder = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    system, folder = _file_system(spark, path)
    system.delete(folder, True)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; folders above its new place are made."""
    system, source = _file_system(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    system.mkdirs(target.getParent())
    if system.exists(target) or not system.rename(source, target):
        raise OSError(f"{path} could not be moved to {to}")


def write_file(spark: SparkSession, path: str, content: bytes) -> None:
    """One small file, wherever Spark can write."""
    system, file = _file_system(spark, path)
    stream = system.create(file, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A stored table; ``merge_schema`` adds up the columns of all its files."""
    return spark.read.parquet(path, mergeSchema=merge_schema)


def write_snapshot(df: DataFrame, spark: SparkSession, label: str) -> str:
    """Write a frame once under the shared folder and return the new path.

    For results that read the table they replace: the old files stay until
    the caller has switched over.
    """
    path = scratch_path(spark, label)
    write_parquet(df, path)
    return path


def switch_location(spark: SparkSession, table: str, path: str) -> None:
    """Point a catalog table at another folder in one metadata change."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


class Layers:
    """Tables at ``root/layer/table``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefixes: set[str] = set()

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"no layer {layer!r}")
        return f"{self.root}/{layer}/{table}"

    def exists(self, layer: str, table: str) -> bool:
        return bool(versions.numbers(self.spark, self.path(layer, table)))

    def read(self, layer: str, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The current version, with the columns of all its files or of ``schema``."""
        return versions.read(self.spark, self.path(layer, table), schema=schema)

    def read_optional(self, layer: str, table: str) -> DataFrame | None:
        return self.read(layer, table) if self.exists(layer, table) else None

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        mode: str = "overwrite",
        partition_by: Sequence[str] = (),
        **options,
    ) -> DataFrame:
        """Store a frame as the next version and return it as stored; see
        ``versions.write`` for the options.

        The version's schema is known, so no file has to be opened for it.
        """
        if len(partition_by) > 1:
            raise ValueError("one partition column at most")
        path = self.path(layer, table)
        stored = versions.write(df, path, mode, *partition_by, **options)
        for prefix in self.prefixes:
            self._show(prefix, layer, table, stored)
        return versions.read(self.spark, path, stored)

    def partition_values(self, layer: str, table: str) -> DataFrame:
        """The values of the partition column that have rows; no file is read."""
        now = versions.current(self.spark, self.path(layer, table))
        kind = T.StructType([now.schema[now.partition]])
        values = self.spark.createDataFrame([(v,) for v in now.partitions()], "v string")
        return values.select(F.col("v").cast(kind[0].dataType).alias(now.partition))

    def expire(self, keep: int = 2, abandoned_after: float | None = None) -> int:
        """Forget the old versions of all tables; returns how many went."""
        return sum(
            versions.expire(self.spark, self.path(layer, table), keep, abandoned_after)
            for layer in LAYERS for table in self._stored(layer) if self.exists(layer, table)
        )

    def register(self, prefix: str) -> DataFrame:
        """Make the current versions known to SQL as ``prefix_layer.table``.

        A table shows the columns of all its files. Returns the listing.
        Dropping a registered table keeps its files. What these ``Layers`` write
        later shows at once, what others write after registering again.
        """
        create_schemas(self.spark, prefix)
        self.prefixes.add(prefix)
        for layer in LAYERS:
            for table in self._stored(layer):
                now = versions.current(self.spark, self.path(layer, table))
                if now:
                    self._show(prefix, layer, table, now)
        return list_tables(self.spark, prefix)

    def _show(self, prefix: str, layer: str, table: str, now: versions.Version) -> None:
        _register_version(self.spark, prefix, layer, table, self.path(layer, table), now)

    def _stored(self, layer: str) -> list[str]:
        return file_names(self.spark, f"{self.root}/{layer}")

    def reset(self, layer: str, prefix: str | None = None) -> None:
        """Delete the tables of a layer with their rows; with ``prefix`` also
        their entries in the catalog. The next load starts from none."""
        for table in self._stored(layer):
            if prefix:
                files = _files_tables(self.spark, prefix, layer, table).values()
                drop_tables(self.spark, [f"{prefix}_{layer}.{table}", *files])
            delete_folder(self.spark, self.path(layer, table))


def _files_tables(spark: SparkSession, prefix: str, layer: str, table: str) -> dict[int, str]:
    """The catalog tables over single versions of a table, by version."""
    schema, start = f"{prefix}_files", f"{layer}__{table}__"
    found = [t.name for t in spark.catalog.listTables(schema)] if spark.catalog.databaseExists(schema) else []
    return {int(n[len(start):]): f"{schema}.{n}" for n in found if n.startswith(start) and n[len(start):].isdigit()}


def _register_version(spark: SparkSession, prefix: str, layer: str, table: str, path: str, now: versions.Version) -> None:
    """A view of the table's columns over a catalog table of one version. The
    view turns to it at once."""
    name, files = f"{prefix}_{layer}.{table}", f"{prefix}_files.{layer}__{table}__{now.number}"
    drop_tables(spark, [files])
    versions.make_version_table(spark, files, path, now)
    if spark.catalog.tableExists(name) and not _is_view(spark, name):
        drop_tables(spark, [name])
    columns = ", ".join(f"`{n}`" for n in now.schema.names)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {files}")
    known = _files_tables(spark, prefix, layer, table)
    drop_tables(spark, [known[n] for n in sorted(known)[:-2]])


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def create_schemas(spark: SparkSession, prefix: str, location: str | None = None) -> None:
    """One schema per layer, and one for the files behind registered tables."""
    for layer in (*LAYERS, "files"):
        place = f" LOCATION '{location.rstrip('/')}/{layer}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}_{layer}{place}")


def create_table(spark: SparkSession, name: str, schema: str, path: str) -> None:
    """An empty typed table, unless it is there."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet LOCATION '{path}'")


def save_table(
    df: DataFrame,
    name: str,
    path: str,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> None:
    """Overwrite a catalog table; ``bucket_by`` lets later joins on exactly
    those columns go without a shuffle. Bucket by keys that are unique, such
    as the person key: a bucket cannot be split at run time.
    """
    writer = df.write.format("parquet").mode("overwrite").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        count, columns = bucket_by
        writer = writer.bucketBy(count, *columns).sortBy(*columns)
    writer.saveAsTable(name)


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Forget tables and views; files outside the warehouse stay (see ``Layers.reset``)."""
    for name in names:
        kind = "VIEW" if spark.catalog.tableExists(name) and _is_view(spark, name) else "TABLE"
        spark.sql(f"DROP {kind} IF EXISTS {name}")


def list_tables(spark: SparkSession, prefix: str) -> DataFrame:
    """schema_name, table_name of all layers."""
    rows = [
        (f"{prefix}_{layer}", t.name)
        for layer in LAYERS
        if spark.catalog.databaseExists(f"{prefix}_{layer}")
        for t in spark.catalog.listTables(f"{prefix}_{layer}")
    ]
    return spark.createDataFrame(rows, "schema_name string, table_name string")


def list_schemas(spark: SparkSession, pattern: str) -> DataFrame:
    """Schemas whose name matches a LIKE pattern."""
    return spark.sql("SHOW SCHEMAS").filter(F.col("namespace").like(pattern))
