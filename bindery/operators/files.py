"""Selecting, naming and counting files of an inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bindery.functions.keys import (
    CENTURY, STEM, archive_key, batch_stamp, dest_key, key_datestamp, needs_relocation, parse_datestamp, processed_key,
)

# Fixed value: age in days after which files go.
RETENTION_DAYS = 30
SECONDS_PER_DAY = 86400


def with_prefix(files: DataFrame, prefix: str, key: str = "key") -> DataFrame:
    return files.filter(F.startswith(F.col(key), F.lit(prefix)))


def with_prefix_suffix(files: DataFrame, prefix: str, suffix: str, key: str = "key") -> DataFrame:
    return with_prefix(files, prefix, key).filter(F.endswith(F.col(key), F.lit(suffix)))


def newest_batch(files: DataFrame, key: str = "key") -> DataFrame:
    """One row: the largest stamp as a number. The stamp's place is read off the first name.

    Both places are tried in the same pass. No files at all, or a name without a stamp in the chosen
    place, is an error.
    """
    name = F.col(key)
    plain, bound = batch_stamp(name, F.lit(False)), batch_stamp(name, F.lit(True))
    tried = files.agg(
        F.coalesce(F.contains(F.min(name), F.lit("boundwith")), F.lit(False)).alias("boundwith"),
        F.max(plain).alias("plain"), F.max(bound).alias("bound"),
        F.min(F.when(plain.isNull(), name)).alias("plain_bad"), F.min(F.when(bound.isNull(), name)).alias("bound_bad"),
    )
    chosen = lambda left, right: F.when(F.col("boundwith"), F.col(left)).otherwise(F.col(right))
    bad, newest = chosen("bound_bad", "plain_bad"), chosen("bound", "plain")
    error = lambda text: F.raise_error(text).cast("long")
    checked = F.when(bad.isNotNull(), error(F.concat(F.lit("no batch stamp in "), bad))).otherwise(
        F.coalesce(newest, error(F.lit("no matching files")))
    )
    return tried.select(checked.alias("newest"))


def batch_candidates(files: DataFrame, stem: str = STEM, key: str = "key") -> DataFrame:
    """Files of the newest batch: all names that start with the stem and the newest stamp.

    The newest stamp is a scalar subquery, evaluated once; no join is made with it.
    """
    newest = newest_batch(with_prefix(files, stem + CENTURY, key), key)
    wanted = F.concat(F.lit(stem), newest.select(F.col("newest").cast("string")).scalar())
    return files.filter(F.startswith(F.col(key), wanted))


def oldest_datestamp(files: DataFrame, prefix: str = "", key: str = "key") -> DataFrame:
    """One row: the earliest datestamp among the keys. Stamps compare as text; none at all is an error."""
    stamps = with_prefix(files, prefix, key).select(key_datestamp(F.col(key)).alias("stamp"))
    oldest = stamps.agg(F.min("stamp").alias("stamp"))
    found = F.coalesce("stamp", F.raise_error(F.lit("no datestamps")).cast("string"))
    return oldest.select(parse_datestamp(found).alias("oldest"))


def prepared_keys(files: DataFrame, source: str, suffix: str, destination: str, key: str = "key") -> DataFrame:
    """Source files and the keys their prepared records go to."""
    chosen = with_prefix_suffix(files, source, suffix, key)
    return chosen.withColumn("dest_key", dest_key(F.col(key), source, suffix, destination))


def listing_order(files: DataFrame, key: str = "key") -> DataFrame:
    return files.orderBy(key)


def older_than_days(mtime: Column, now: Column, days: int = RETENTION_DAYS) -> Column:
    """Age in whole days above ``days``, so 30 needs 31 full days."""
    age = F.timestamp_diff("SECOND", mtime, now)
    return F.floor(age / SECONDS_PER_DAY) > days


def at_depth(path: Column, least: int = 1, most: int | None = None) -> Column:
    """Number of path parts below the root."""
    parts = F.size(F.split(path, "/"))
    return parts >= least if most is None else parts.between(least, most)


def expired_files(
    files: DataFrame, now: Column, days: int = RETENTION_DAYS, least: int = 1, most: int | None = None
) -> DataFrame:
    return files.filter(older_than_days(F.col("mtime"), now, days) & at_depth(F.col("key"), least, most))


def parent_of(path: Column) -> Column:
    """Path without its last part; empty at the root."""
    last = F.substring_index(path, "/", -1)
    return F.substr(path, F.lit(1), F.greatest(F.length(path) - F.length(last) - F.lit(1), F.lit(0)))


def empty_dirs(dirs: DataFrame, entries: DataFrame, path: str = "path") -> DataFrame:
    """Directories with nothing in them. ``entries`` holds files and directories."""
    parents = entries.select(parent_of(F.col(path)).alias(path)).distinct()
    return dirs.join(parents, path, "left_anti")


def emptied_dirs(dirs: DataFrame, files: DataFrame, path: str = "path", most_levels: int = 64) -> DataFrame:
    """Directories with no file beneath them at any depth, as removed by repeated passes: a folder of empty folders is one.

    Each file's folders are closed upwards: a row for every ancestor, made distinct in the tasks before the shuffle, and
    the directories that are not among them are left. A path of more than ``most_levels`` parts is an error.
    """
    parts = F.split(F.col(path), "/")
    deep = F.raise_error(F.concat(F.lit(f"more than {most_levels} levels: "), F.col(path))).cast("array<string>")
    checked = F.when(F.size(parts) > most_levels, deep).otherwise(parts)
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.size(checked) - 1, F.lit(1))), lambda n: F.array_join(F.slice(checked, F.lit(1), n), "/"))
    held = files.filter(F.size(parts) > 1).select(F.explode(above).alias(path)).distinct()
    return dirs.join(held, path, "left_anti")


def move_conflicts(moves: DataFrame, source: str = "key", target: str = "moved_to") -> DataFrame:
    """Moves that cannot be done in any order or at once: ``key``, ``moved_to``, and ``conflict``.

    ``same_target``: several sources go to one place. ``occupied``: the place is the source of another move, so that one has to
    go first; in a ring no order is right. A place that is the row's own source is no move and no conflict.
    """
    real = moves.filter(F.col(source) != F.col(target)).select(F.col(source).alias("key"), F.col(target).alias("moved_to"))
    targets = real.groupBy("moved_to").agg(F.count_distinct("key").alias("sources")).filter("sources > 1").select("moved_to")
    same = real.join(targets, "moved_to", "left_semi").withColumn("conflict", F.lit("same_target"))
    sources = real.select(F.col("key").alias("moved_to")).distinct()
    occupied = real.join(sources, "moved_to", "left_semi").withColumn("conflict", F.lit("occupied"))
    columns = ["key", "moved_to", "conflict"]
    return same.select(*columns).unionByName(occupied.select(*columns))


def relocations(files: DataFrame, key: str = "key") -> DataFrame:
    """Loaded files and where they move; names that stay are left out."""
    return files.filter(needs_relocation(F.col(key))).withColumn("moved_to", processed_key(F.col(key)))


def unprocessed(files: DataFrame, processed: DataFrame, key: str = "key") -> DataFrame:
    """Files not yet in the ledger of processed ones."""
    return files.join(processed.select(key).distinct(), key, "left_anti")


def archived(files: DataFrame, stamp: Column, folder: str = "archive", key: str = "key") -> DataFrame:
    """Transferred files with the place they are kept."""
    return files.withColumn("archive_key", archive_key(F.col(key), stamp, folder))


def files_moved(files: DataFrame, by: str) -> DataFrame:
    return files.groupBy(by).agg(F.count("*").alias("moved"))


def records_per_file(records: DataFrame, by: str = "src_key") -> DataFrame:
    """Records of each file, and of all files in the row whose key is null.

    The total is rolled up from the counts per file, so the records are passed over once.
    """
    counts = records.groupBy(by).agg(F.count("*").alias("records"))
    return counts.rollup(by).agg(F.sum("records").alias("records"))


def count_docs(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count("*").alias("num_found"))
