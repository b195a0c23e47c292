"""Column expressions: cleaning, hashing, and parsing of loosely typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for no value. Fixed values.
EMPTY = ("", " ", "None", "[ ]", "[]", "{}")


def blank_to_null(c: Column) -> Column:
    """Trimmed text; null where it stands for no value."""
    t = F.trim(c)
    return F.when(t.isin(*EMPTY), None).otherwise(t)


def or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def safe_int(c: Column) -> Column:
    """Whole number of a messy text: thousands separators and blanks dropped, inner ones too; negatives, nulls and non-numbers are 0."""
    plain = F.regexp_replace(c, r"[,\s]", "")
    return F.greatest(F.lit(0).cast("long"), F.coalesce(plain.try_cast("double").cast("long"), F.lit(0).cast("long")))


def first_digits(c: Column) -> Column:
    """The first run of digits as a number; null without one."""
    return F.nullif(F.regexp_extract(c, "([0-9]+)", 1), F.lit("")).cast("long")


def md5_bucket(key: Column, buckets: int) -> Column:
    """md5(trim(key)) modulo ``buckets``, exact: two 16-digit limbs, as 128 bits exceed every integer type."""
    digest = F.md5(F.trim(key.cast("string")).cast("binary"))
    high, low = (F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17))
    return ((high % buckets * F.lit(2**64 % buckets) + low % buckets) % buckets).cast("long")


def composite_key(*parts: Column) -> Column:
    """a|b; null where a part is missing or empty."""
    texts = [blank_to_null(p.cast("string")) for p in parts]
    present = texts[0].isNotNull()
    for t in texts[1:]:
        present = present & t.isNotNull()
    return F.when(present, F.concat_ws("|", *texts))


def distinct_tags(c: Column) -> Column:
    """Tags of a JSON array or a comma list, trimmed, distinct in order of first appearance."""
    listed = F.when(F.trim(c).startswith("["), F.from_json(c, "array<string>")).otherwise(F.split(c, ","))
    return F.array_distinct(F.filter(F.transform(listed, lambda x: F.trim(x)), lambda x: x != ""))


def count_of(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is nothing."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
