"""Parquet tables.

A table is either one folder (raw and conformed tables, replaced as a whole), a folder of
numbered versions (dimensions: the new state is computed from the old, which therefore must
stay readable), or a folder partitioned by month (facts: touched months are replaced).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.keys import pack_keys, text_keys, unpack_keys
from martwright.session import freed_shuffles

CODEC = "snappy"
# Versions, months and places hold hashed keys, which snappy leaves at 64 bytes each.
GOLD_CODEC = "zstd"
# Fixed value: Spark's folder name for rows whose partition column is NULL.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def folder_name(table: str) -> str:
    """``Schema.Table`` as a folder name."""
    return table.replace(".", "_").lower()


def read_table(spark: SparkSession, root: str, table: str, schema: str | None = None) -> DataFrame:
    """A table folder. With a schema (DDL) no footer is read, and a table without files is empty."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{root}/{folder_name(table)}")


def table_exists(spark: SparkSession, root: str, table: str) -> bool:
    """Whether a write of the table committed."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{folder_name(table)}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def write_table(df: DataFrame, root: str, table: str, partition_by: list[str] | None = None) -> str:
    """Replace the table; ``df`` must not read from it."""
    path = f"{root}/{folder_name(table)}"
    writer = df.write.mode("overwrite").option("compression", CODEC)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def append_table(df: DataFrame, root: str, table: str) -> str:
    path = f"{root}/{folder_name(table)}"
    df.write.mode("append").option("compression", CODEC).parquet(path)
    return path


def count_written(spark: SparkSession, path: str) -> int:
    """Rows in a written table: a count without columns reads file footers only."""
    return spark.read.parquet(path).count()


def _versions(spark: SparkSession, root: str, table: str, committed: bool = True) -> list[int]:
    """Numbers of the versions whose write committed, or of all that were begun."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{root}/{folder_name(table)}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(hadoop.Path(folder, "v=*/_SUCCESS" if committed else "v=*")) if files.exists(folder) else None
    paths = [s.getPath().getParent() if committed else s.getPath() for s in found or []]
    return sorted(int(p.getName().removeprefix("v=")) for p in paths)


def read_version(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame | None:
    """The newest committed version, or a given one; None before the first."""
    known = _versions(spark, root, table)
    if not known:
        return None
    return spark.read.parquet(f"{root}/{folder_name(table)}/v={version or known[-1]}")


def write_version(df: DataFrame, root: str, table: str, partition_by: list[str] | None = None) -> int:
    """Write the next version beside the older ones. Spark's commit marker publishes it, so
    readers see the old state until every file is in place."""
    number = max(_versions(df.sparkSession, root, table, committed=False), default=0) + 1
    # two writers that chose the same number must not overwrite each other: the later one fails
    writer = df.write.mode("errorifexists").option("compression", GOLD_CODEC)
    path = f"{root}/{folder_name(table)}/v={number}"
    with freed_shuffles(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return number


def month_keyed(df: DataFrame) -> DataFrame:
    """Rows with their ``month_key``, from ``date_key`` unless they have one."""
    return df if "month_key" in df.columns else df.withColumn("month_key", F.expr("date_key div 100").cast("int"))


def by_month(df: DataFrame) -> DataFrame:
    """Rows with their ``month_key``, gathered for a write by month."""
    return gathered(month_keyed(df), ["month_key"])


def gathered(df: DataFrame, by: list[str]) -> DataFrame:
    """The same rows, those of a month (or place) together: in few files, yet AQE may split one too big for a task.
    Hashed keys travel packed."""
    keys = [c for c in text_keys(df) if c not in by]
    return unpack_keys(pack_keys(df, keys).hint("rebalance", *by), keys)


def replace_all_months(df: DataFrame, root: str, table: str) -> str:
    """Write the whole table by month; months it no longer holds are gone."""
    path = f"{root}/{folder_name(table)}"
    writer = by_month(df).write.mode("overwrite").option("partitionOverwriteMode", "static")
    with freed_shuffles(df.sparkSession):
        writer.option("compression", GOLD_CODEC).partitionBy("month_key").parquet(path)
    return path


def _folder(by: list[str], place: tuple[int | None, ...]) -> str:
    """Spark's folder of a partition, below the table."""
    return "/".join(f"{c}={NO_MONTH if v is None else v}" for c, v in zip(by, place, strict=True))


def _part_files(spark: SparkSession, path: str, depth: int, folders: set[str] | None = None) -> dict[str, set[str]]:
    """Names of the files in each partition folder (or in those given), by the folder's path below the table."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    below = "*=*/" * depth if folders is None else f"{{{','.join(sorted(folders))}}}/"
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop.Path(folder, f"{below}part-*"))
    files: dict[str, set[str]] = {}
    # one text for all: a call to the JVM for every file takes longer than the write of a slice
    paths = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.Object, len(found or []))
    if found:
        spark._jvm.java.lang.System.arraycopy(hadoop.FileUtil.stat2Paths(found), 0, paths, 0, len(found))
    for line in spark._jvm.org.apache.commons.lang3.StringUtils.join(paths, "\n").splitlines():
        *_, name = parts = line.split("/")
        files.setdefault("/".join(parts[-1 - depth : -1]), set()).add(name)
    return files


def _replace_parts(df: DataFrame, rows: DataFrame, path: str, by: list[str], places: list[tuple[int | None, ...]]) -> None:
    """Overwrite the partitions that ``rows`` holds, and empty those of ``places`` that it does not.

    The rows are computed and written once. Which partitions they held shows in the files: a partition that was
    written has new ones only.
    """
    spark = df.sparkSession
    folders = {_folder(by, place) for place in places}
    before = _part_files(spark, path, len(by), folders) if places else {}
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with freed_shuffles(spark):
        writer.option("compression", GOLD_CODEC).partitionBy(*by).parquet(path)
    if not places:
        return
    held = {folder for folder, names in _part_files(spark, path, len(by), folders).items() if not names & before.get(folder, set())}
    nothing = spark.createDataFrame([], rows.drop(*by).schema)
    for folder in folders - held:
        nothing.write.mode("overwrite").option("compression", GOLD_CODEC).parquet(f"{path}/{folder}")


def stored_months(spark: SparkSession, root: str, table: str) -> list[int | None]:
    """Months that have files, by the names of their folders."""
    names = [folder.removeprefix("month_key=") for folder in _part_files(spark, f"{root}/{folder_name(table)}", 1)]
    return [None if name == NO_MONTH else int(name) for name in names]


def clear_months(spark: SparkSession, root: str, table: str, months: list[int | None]) -> None:
    """Delete the folders of the given months."""
    for month in months:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{folder_name(table)}/month_key={NO_MONTH if month is None else month}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_months(spark: SparkSession, root: str, table: str, schema: str, months: list[int | None]) -> DataFrame:
    """The given months of a table stored by month, with their ``month_key``; no other folder is listed. Each must be stored."""
    path = f"{root}/{folder_name(table)}"
    reader = spark.read.schema(f"{schema}, month_key int").option("basePath", path)
    return reader.parquet(*[f"{path}/{_folder(['month_key'], (m,))}" for m in months])


def replace_months(df: DataFrame, root: str, table: str, months: list[int | None] | None = None, gather: bool = True) -> str:
    """Overwrite only the month partitions that ``df`` holds rows for; it must hold these months in full.

    ``months`` are those the caller has recomputed: one that came back without rows is emptied. Without ``gather`` each task
    writes a file for each month it has rows of, and the rows are spared a shuffle: for a few months at a time.
    """
    path = f"{root}/{folder_name(table)}"
    _replace_parts(df, by_month(df) if gather else month_keyed(df), path, ["month_key"], [(m,) for m in months or []])
    return path


def read_places(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """A table that ``replace_places`` keeps, without a look into its files; None before the first write."""
    shape = read_version(spark, root, f"{table}_shape")
    return None if shape is None else spark.read.schema(shape.schema).parquet(f"{root}/{folder_name(table)}")


def replace_places(df: DataFrame, root: str, table: str, places: list[tuple[int | None, ...]], by: list[str]) -> str:
    """Overwrite the given partitions (values of the columns ``by``) with ``df``, which holds all their rows and no others.

    Partitions that are not named stay as they are; a named one that came back without rows is emptied.
    """
    path = f"{root}/{folder_name(table)}"
    if read_version(df.sparkSession, root, f"{table}_shape") is None:
        write_version(df.filter("false"), root, f"{table}_shape")
    _replace_parts(df, gathered(df, by), path, by, places)
    return path
