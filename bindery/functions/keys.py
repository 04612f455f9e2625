"""File names, batch stamps and object keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bindery.functions.text import substring_after, substring_before

# Name stems, positions of the stamp between underscores, formats and folder names.
STEM = "alma_bibs__"
BOUNDWITH_STEM = "alma_bibs__boundwith2_"
CENTURY = "20"
STAMP_AT, BOUNDWITH_STAMP_AT = 3, 4
BATCH_FORMAT = "yyyyMMddHH"
NAMESPACE_FORMAT = "yyyy-MM-dd_HH-mm-ss"
HARVEST_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DATESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'z'"
DATESTAMP_IN_KEY = "alma_bibs__(.*)_.*"
OVERLAP_HOURS = 24
FOLDER_MOVES = {"new-updated": "processed-new-updated", "deleted": "processed-deleted"}
BLANKS = ["", "None"]
LANGUAGES = {"es": "spa", "eng": "eng"}


def is_blank(value: Column) -> Column:
    """Null, empty, or the word None."""
    return value.isNull() | value.isin(BLANKS)


def or_default(value: Column, default: Column | str | None) -> Column:
    """``value`` unless it is blank."""
    default = default if isinstance(default, Column) else F.lit(default)
    return F.when(is_blank(value), default).otherwise(value)


def batch_stamp(name: Column, boundwith: Column) -> Column:
    """The numeric stamp in a file name, null when there is none.

    ``boundwith`` is one decision for the whole listing.
    """
    at = F.when(boundwith, F.lit(BOUNDWITH_STAMP_AT)).otherwise(F.lit(STAMP_AT))
    return F.get(F.split(name, "_"), at).try_cast("long")


def key_datestamp(key: Column) -> Column:
    """The text between the stem and the last underscore; null when the key has another form."""
    return F.when(key.rlike(DATESTAMP_IN_KEY), F.regexp_extract(key, DATESTAMP_IN_KEY, 1))


def parse_datestamp(text: Column) -> Column:
    """A key datestamp as a timestamp; text of another form is an error."""
    return F.to_timestamp_ntz(text, F.lit(DATESTAMP_FORMAT))


def dest_key(key: Column, source: str, suffix: str, destination: str) -> Column:
    """Drop every ``suffix`` and replace every ``source`` prefix by the destination stem."""
    bare = F.replace(key, F.lit(suffix), F.lit("")) if suffix else key
    return F.replace(bare, F.lit(source), F.lit(f"{destination}/{STEM}"))


def flat_name(key: Column, base: str) -> Column:
    """One flat file name for a nested key."""
    return F.concat(F.lit(base), F.replace(key, F.lit("/"), F.lit("-")), F.lit(".xml"))


def landing_key(name: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), name)


def listing_path(name: Column, base: str) -> Column:
    return F.concat(F.lit(base), F.lit("/"), name)


def processed_key(key: Column) -> Column:
    """The key after a load: the first occurrence of each folder name is replaced, in turn."""
    for folder, moved in FOLDER_MOVES.items():
        key = F.regexp_replace(key, f"(?s)^(.*?){folder}", f"$1{moved}")
    return key


def needs_relocation(key: Column) -> Column:
    return key != processed_key(key)


def archive_key(name: Column, stamp: Column, folder: str = "archive") -> Column:
    """Where a transferred file is kept."""
    return F.concat(F.lit(folder + "/"), stamp.cast("string"), F.lit("/"), name)


def snapshot_name(configured: Column, configset: Column, stamp: Column, version: Column | None = None) -> Column:
    """The configured name, or one made from the configuration, its version and the stamp."""
    stem = configset if version is None else F.concat(configset, F.lit("."), version)
    return F.when(is_blank(configured), F.concat(stem, F.lit("-"), stamp)).otherwise(configured)


def namespace_stamp(moment: Column) -> Column:
    return F.date_format(moment, NAMESPACE_FORMAT)


def overlap_from(stamp: Column) -> Column:
    """Start of the next harvest after a rebuild: one day before the batch stamp."""
    moment = F.to_timestamp_ntz(stamp.cast("string"), F.lit(BATCH_FORMAT))
    return F.date_format(moment - F.expr(f"INTERVAL {OVERLAP_HOURS} HOURS"), HARVEST_FORMAT)


def clean_item_id(doi: Column) -> Column:
    """The identifier behind the resolver name, other characters replaced by an underscore."""
    return F.regexp_replace(substring_after(doi, "doi.org/"), "[^a-zA-Z0-9\\-:_]", "_")


def filename_id(filename: Column) -> Column:
    return substring_before(filename, ".pdf")


def map_language(code: Column) -> Column:
    """Three-letter code for the languages that need one; others unchanged."""
    out = F
    for source, target in LANGUAGES.items():
        out = out.when(code == F.lit(source), F.lit(target))
    return out.otherwise(code)
