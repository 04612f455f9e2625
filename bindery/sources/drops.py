"""Listings, lookup files and drop folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bindery.schemas import INVENTORY, LOOKUP_CSV

CSV_QUOTING = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}


def under_prefix(key: Column, prefix: str, delimiter: str = "/") -> Column:
    """Key below ``prefix``; with a delimiter only keys that have none behind the prefix."""
    below = F.startswith(key, F.lit(prefix))
    if not delimiter:
        return below
    return below & (F.instr(F.substr(key, F.lit(len(prefix) + 1)), delimiter) == 0)


def folder_of(prefix: str) -> str:
    """The folder that holds every key below ``prefix``, empty for the root.

    Also empty where a part of the folder means something else as a path: patterns, empty or dotted parts, hidden names.
    """
    folder = prefix.rpartition("/")[0]
    plain = all(part and part[0] not in "._" and not set(part) & set("*?[]{}\\") for part in folder.split("/"))
    return folder if plain else ""


def list_files(spark: SparkSession, path: str, prefix: str = "", delimiter: str = "/") -> DataFrame:
    """Files under ``path`` as key, mtime and size. File contents are not read.

    Only the folder that the prefix names is listed, if it is a plain one; without that folder there are no files.
    """
    # Cut by the length of the whole root, since its last part may recur below it.
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    root = system.makeQualified(root).toString().rstrip("/")
    folder = folder_of(prefix)
    if folder and not any(c in path for c in "*?[]{}"):
        start = f"{path.rstrip('/')}/{folder}"
        if not system.exists(spark._jvm.org.apache.hadoop.fs.Path(start)):
            return spark.createDataFrame([], INVENTORY)
    else:
        start = path
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(start)
    key = F.substr("path", F.lit(len(root) + 2))
    listed = files.select(key.alias("key"), F.col("modificationTime").alias("mtime"), F.col("length").alias("size"))
    return listed.filter(under_prefix(F.col("key"), prefix, delimiter))


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The child lookup file; attributes in its XML column are quote-doubled.

    ``ord`` is the place of a row: the number of its file, the file, then its place in it. Files are read whole and in order.
    """
    rows = spark.read.options(**CSV_QUOTING).schema(LOOKUP_CSV).csv(path)
    file = F.input_file_name()
    # Part numbers grow past their five digits, so they are compared as numbers.
    part = F.regexp_extract(F.substring_index(file, "/", -1), "^part-([0-9]+)", 1).try_cast("long")
    place = F.struct(part.alias("part"), file.alias("file"), F.monotonically_increasing_id().alias("row"))
    return rows.withColumn("ord", place)


def read_csv_drop(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Every CSV file of a folder; other files are ignored."""
    return spark.read.options(pathGlobFilter="*.csv", **CSV_QUOTING).schema(schema).csv(path)


def read_json_drop(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Every JSON file of a folder; other files are ignored."""
    return spark.read.option("pathGlobFilter", "*.json").schema(schema).json(path)
