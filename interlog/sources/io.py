"""Sources and sinks: typed loads, exports with reuse, snapshots, fold / shard exports, catalog helpers."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed mapping of the reference's local dtype names onto engine types.
DTYPES = {
    "int8": "tinyint", "uint8": "smallint", "int16": "smallint", "uint16": "int", "int32": "int",
    "int64": "bigint", "int": "int", "float32": "float", "float64": "double", "float": "double",
    "bool": "boolean", "str": "string",
}


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a declared schema (no inference) and one header row."""
    return spark.read.schema(schema).option("header", True).csv(path)


def load_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_table(spark: SparkSession, name: str, max_rows: int | None = None,
               dtypes: Mapping[str, str] | None = None) -> DataFrame:
    """Table read with optional casts (unparseable values become null); ``max_rows`` bounds a sample read."""
    df = spark.table(name)
    if dtypes:
        df = df.select(*[F.col(c).try_cast(DTYPES.get(dtypes[c], dtypes[c])).alias(c) if c in dtypes else F.col(c)
                         for c in df.columns])
    return df.limit(max_rows) if max_rows else df


def plan_fingerprint(df: DataFrame, *options: object) -> str:
    """Stable identifier of a query's analysed plan, its input files and the way it is written."""
    files = "\n".join(sorted(df.inputFiles()))
    text = "\x1f".join([str(df.semanticHash()), df.schema.json(), files, *map(str, options)])
    return "q" + hashlib.sha256(text.encode()).hexdigest()


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether an earlier write to the folder ended well."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def export_query(df: DataFrame, root: str, fmt: str = "csv", header: bool = True,
                 overwrite: bool = False) -> str:
    """Write a query result as many files under ``root/<fingerprint>``; a complete export of the same
    plan, inputs, format and header is reused unless ``overwrite``."""
    path = f"{root.rstrip('/')}/{plan_fingerprint(df, fmt, header if fmt == 'csv' else None)}"
    if not overwrite and _complete(df.sparkSession, path):
        return path
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", header).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def read_exported(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str,
                  header: bool = True) -> DataFrame:
    """Read every shard of an export (a directory read is the concatenation)."""
    r = spark.read.schema(schema)
    if fmt == "csv":
        return r.option("header", header).csv(path)
    return r.format(fmt).load(path)


def typed_snapshot(df: DataFrame, path: str, dtypes: Mapping[str, str], default: str = "int",
                   fill=None) -> tuple[DataFrame, list[str]]:
    """Fill nulls, cast every column (unlisted ones to ``default``), persist as parquet and reload.
    Returns the reloaded frame and the columns whose cast produced new nulls (left uncast)."""
    base = df.fillna(fill) if fill is not None else df
    target = {c: DTYPES.get(dtypes.get(c, default), dtypes.get(c, default)) for c in base.columns}
    checks = base.agg(*[F.sum((F.col(c).isNotNull() & F.col(c).try_cast(target[c]).isNull()).cast("long"))
                        .alias(c) for c in base.columns]).first().asDict()
    failed = [c for c, n in checks.items() if n]
    out = base.select(*[F.col(c) if c in failed else F.col(c).cast(target[c]).alias(c) for c in base.columns])
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path), failed


def fold_export(df: DataFrame, path: str, label: str, cols: Sequence[str]) -> None:
    """One headerless, label-first CSV set per fold (``fold=<n>`` folders)."""
    df.select(label, *cols, "fold").write.mode("overwrite").partitionBy("fold").option("header", False).csv(path)


def shard_export(df: DataFrame, path: str, split: str, rows_per_file: int) -> DataFrame:
    """Parquet shards per split with at most ``rows_per_file`` rows each; returns rows per shard file."""
    df.write.mode("overwrite").partitionBy(split).option("maxRecordsPerFile", rows_per_file).parquet(path)
    back = df.sparkSession.read.parquet(path)
    return back.groupBy(split, F.input_file_name().alias("file")).agg(F.count("*").alias("rows"))


def exact_shards(df: DataFrame, path: str, split: str, size: int, order: Sequence[str],
                 held: Mapping[str, Column] | None = None) -> DataFrame:
    """Parquet shards of exactly ``size`` rows in the order ``order`` within each split; a split's last holds the rest.

    A row's shard is its position in its split divided by ``size``. One task writes a shard as one file in a folder that
    names its number and rows (``shard=00012-1000rows``); ``_manifest`` beside them lists (split, shard, rows, folder) and
    is returned. ``order`` must tell the rows of a split apart; a null split is a split like others. The files are listed
    and read back once, for the manifest and for ``held``: further aggregates of each shard's rows, columns of the manifest.
    """
    from interlog.operators.ranges import positions
    from interlog.session import sized_broadcast

    spark = df.sparkSession
    placed = positions(df, [split, *order], "_at")
    ends = placed.groupBy(F.col(split).alias("_split")).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    at = placed.join(sized_broadcast(ends), placed[split].eqNullSafe(F.col("_split")))
    number = F.floor((F.col("_at") - F.col("_first")) / size).cast("long")
    rows = F.least(F.lit(size).cast("long"), F.col("_rows") - number * size)
    folder = F.format_string("%05d-%drows", number, rows)
    shards = at.withColumn("shard", folder).select(*df.columns, "shard").repartition(split, "shard")
    shards.sortWithinPartitions(split, "shard", *order).write.mode("overwrite").partitionBy(split, "shard").parquet(path)
    back = spark.read.schema(shards.schema).parquet(path).withColumn("_file", F.input_file_name())
    found = back.groupBy(split, F.col("shard").alias("folder")).agg(
        F.count("*").alias("rows"), F.size(F.collect_set("_file")).cast("long").alias("files"), *[c.alias(n) for n, c in (held or {}).items()])
    manifest = found.select(split, F.substring_index("folder", "-", 1).cast("long").alias("shard"), "rows", "files", "folder", *(held or {}))
    manifest.write.mode("overwrite").json(path.rstrip("/") + "/_manifest")
    return spark.read.schema(manifest.schema).json(path.rstrip("/") + "/_manifest")


def table_profile(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Per table: column count and row count (one aggregate per table, bounded by the table list)."""
    rows = []
    for n in names:
        t = spark.table(n)
        rows.append(t.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(n).alias("table_name"), F.lit(len(t.columns)).cast("long").alias("n_columns"), "n_rows"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def table_sizes(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Per table: number of files and bytes on storage. File lengths come from the ``binaryFile``
    source over the table's input files; only metadata columns are selected, so no contents are read."""
    out = None
    for n in names:
        files = spark.table(n).inputFiles()
        d = (spark.read.format("binaryFile").load(list(files)).select("length")
             .agg(F.count("*").alias("n_files"), F.sum("length").alias("size_bytes"))
             .select(F.lit(n).alias("table_name"), "n_files", "size_bytes"))
        out = d if out is None else out.unionByName(d)
    return out


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS, optionally at an explicit (shared) location."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """CREATE OR REPLACE TABLE ... AS: overwrite a catalog table with the frame; with ``path`` the
    table's files live at that (shared) location."""
    w = df.write.mode("overwrite")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def add_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Widen the schema with null columns of the given types."""
    return df.withColumns({n: F.lit(None).cast(DTYPES.get(t, t)) for n, t in columns.items()})


def write_state_snapshot(tables: Mapping[str, DataFrame], path: str, columns: Sequence[str]) -> DataFrame:
    """Persist the serving state tables (parquet per table) and a JSON manifest with the feature column
    list and each table's schema; returns the manifest read back."""
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
    manifest = [(name, json.dumps(df.columns), json.dumps(list(columns))) for name, df in tables.items()]
    spark.createDataFrame(manifest, "table_name string, table_columns string, feature_columns string") \
        .write.mode("overwrite").json(f"{path.rstrip('/')}/_manifest")
    return spark.read.schema("table_name string, table_columns string, feature_columns string").json(
        f"{path.rstrip('/')}/_manifest")
