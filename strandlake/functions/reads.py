"""Reads and names as Columns: qualities, identities, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def phred(quality: Column) -> Column:
    """Scores of a Phred+33 text."""
    scores = F.transform(F.split(quality, ""), lambda c: F.ascii(c) - 33)
    return F.when(F.length(quality) > 0, scores).otherwise(F.array().cast("array<int>"))


def mean_quality(quality: Column) -> Column:
    total = F.aggregate(phred(quality), F.lit(0).cast("long"), lambda acc, q: acc + q)
    return F.when(F.length(quality) > 0, total / F.length(quality)).otherwise(0.0)


def stable_uid(source_sha256: Column, record_index: Column) -> Column:
    """Identity of a record: SHA-256 of the file's digest, NUL and the record's number."""
    return F.sha2(F.concat(F.lower(source_sha256), F.char(F.lit(0)), record_index.cast("string")), 256)


def stable_rank(uid: Column, group: Column, seed: int) -> Column:
    """Order of reads in a group that depends on nothing but their names."""
    return F.sha2(F.concat(F.lit(str(seed)), F.char(F.lit(0)), group, F.char(F.lit(0)), uid), 256)


def safe_name(name: Column, longest: int = 56) -> Column:
    """A name for files: other characters become _, long ones end in a digest."""
    clean = F.trim(F.regexp_replace(name, "[^A-Za-z0-9._-]+", "_"), F.lit("._-"))
    clean = F.when(clean == "", "unnamed").otherwise(clean)
    short = F.concat(F.substring(clean, 1, longest - 9), F.lit("~"), F.substring(F.sha2(name, 256), 1, 8))
    return F.when(F.length(clean) > longest, short).otherwise(clean)


def normalized_well(well: Column) -> Column:
    """A1 as A01; other names as they are, in upper case."""
    upper = F.upper(F.trim(well))
    row, column = F.regexp_extract(upper, "^([A-Z]+)0*([0-9]+)$", 1), F.regexp_extract(upper, "^([A-Z]+)0*([0-9]+)$", 2)
    return F.when(row != "", F.concat(row, F.when(F.length(column) < 2, F.lpad(column, 2, "0")).otherwise(column))).otherwise(upper)


def block_of(reference_id: Column, pattern: str = r"^Block_(\d+)_") -> Column:
    """The block that a reference's name states: the pattern's first group, or the whole match; null without a match."""
    import re

    group = 1 if re.compile(pattern).groups else 0
    found = F.regexp_extract(reference_id, pattern, group)
    return F.when(found == "", None).otherwise(found)


def reference_parts(name: Column) -> Column:
    """encoding, block and key of names like A_Block_3_key."""
    pattern = r"^([AB])_Block_(\d+)_(.+)$"
    part = lambda i: F.nullif(F.regexp_extract(name, pattern, i), F.lit(""))
    return F.struct(part(1).alias("encoding"), part(2).cast("int").alias("block"), part(3).alias("key"))


def alias_key(ids: Column) -> Column:
    """One name for references that share a sequence."""
    return F.array_join(F.array_sort(ids), "|")


def describe_mixed(position: Column, reference: Column, alleles: Column, fractions: Column, region: Column, effect: Column) -> Column:
    """One line about a mixed position (counted from 1)."""
    shares = F.array_join(F.transform(fractions, lambda f: F.format_string("%.2f", f)), ",")
    return F.concat_ws(" ", F.format_string("%d:%s>%s", position + 1, reference, alleles), F.concat(F.lit("("), shares, F.lit(")")), region, effect)


def canonical_digest(*columns: Column) -> Column:
    """SHA-256 of the columns as JSON with nulls kept, in the order given."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def html_value(value: Column) -> Column:
    """Text that is safe inside HTML."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def duration(seconds: Column) -> Column:
    whole = F.floor(seconds).cast("long")
    return F.when(whole >= 3600, F.format_string("%dh %02dm %02ds", (whole / 3600).cast("long"), (whole % 3600 / 60).cast("long"), whole % 60)).otherwise(F.format_string("%dm %02ds", (whole / 60).cast("long"), whole % 60))
