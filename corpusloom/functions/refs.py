"""Canonical references ``BOOK.CHAPTER.VERSE``: grammar, order, collections, versions and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Collection codes in canonical order, each with its number of groups.
COLLECTIONS = {
    "GEN": 50, "EXO": 40, "LEV": 27, "NUM": 36, "DEU": 34, "JOS": 24, "JDG": 21, "RUT": 4, "1SA": 31, "2SA": 24,
    "1KI": 22, "2KI": 25, "1CH": 29, "2CH": 36, "EZR": 10, "NEH": 13, "EST": 10, "JOB": 42, "PSA": 150, "PRO": 31,
    "ECC": 12, "SNG": 8, "ISA": 66, "JER": 52, "LAM": 5, "EZK": 48, "DAN": 12, "HOS": 14, "JOL": 3, "AMO": 9,
    "OBA": 1, "JON": 4, "MIC": 7, "NAM": 3, "HAB": 3, "ZEP": 3, "HAG": 2, "ZEC": 14, "MAL": 4, "MAT": 28,
    "MRK": 16, "LUK": 24, "JHN": 21, "ACT": 28, "ROM": 16, "1CO": 16, "2CO": 13, "GAL": 6, "EPH": 6, "PHP": 4,
    "COL": 4, "1TH": 5, "2TH": 3, "1TI": 6, "2TI": 4, "TIT": 3, "PHM": 1, "HEB": 13, "JAS": 5, "1PE": 5,
    "2PE": 3, "1JN": 5, "2JN": 1, "3JN": 1, "JUD": 1, "REV": 22,
}
#: Collections held out by name.
HELD_OUT = {"test": ["RUT", "JON", "PHP", "JUD", "3JN"], "val": ["OBA", "TIT", "PHM", "2JN", "NAM"]}

UNKNOWN_ORDINAL, UNKNOWN_SEGMENT = 999, 999_999
REFERENCE = r"^([0-9A-Z]{3})\.([0-9]+)\.([0-9]+[a-z]?)\z"


def is_reference(c: Column) -> Column:
    return c.rlike(REFERENCE)


def book(c: Column) -> Column:
    """The collection of a valid reference, the empty text of another."""
    return F.regexp_extract(c, REFERENCE, 1)


def chapter(c: Column) -> Column:
    return F.coalesce(F.regexp_extract(c, REFERENCE, 2).try_cast("int"), F.lit(0))


def verse(c: Column) -> Column:
    return F.when(is_reference(c), F.regexp_extract(c, REFERENCE, 3)).otherwise("0")


def reference(book: Column, chapter: Column, verse: Column) -> Column:
    return F.concat_ws(".", book, chapter.cast("string"), verse.cast("string"))


def collections(spark: SparkSession) -> DataFrame:
    """``book_code``, ``ordinal``, ``expected_chapters``: 66 rows."""
    return spark.createDataFrame([(c, i, n) for i, (c, n) in enumerate(COLLECTIONS.items())], "book_code string, ordinal int, expected_chapters int")


def ordinal(code: Column, codes: list[str] | None = None) -> Column:
    """The place of a code in the canonical order, 999 if it has none."""
    at = F.array_position(F.array(*map(F.lit, codes or list(COLLECTIONS))), code)
    return F.when(at > 0, (at - 1).cast("int")).otherwise(UNKNOWN_ORDINAL)


def segment_number(v: Column) -> Column:
    return F.coalesce(F.regexp_extract(v, r"^([0-9]+)[a-z]*\z", 1).try_cast("int"), F.lit(UNKNOWN_SEGMENT))


def segment_suffix(v: Column) -> Column:
    return F.regexp_extract(v, r"^[0-9]+([a-z]*)\z", 1)


def canonical_order(c: Column) -> list[Column]:
    """Sort keys: collection, group number, segment number, suffix, the reference itself."""
    v = verse(c)
    return [ordinal(book(c)), chapter(c), segment_number(v), segment_suffix(v), c]


def split_bucket(code: Column, buckets: int = 10) -> Column:
    return F.pmod(F.conv(F.substring(F.sha2(code, 256), 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def split_label(code: Column) -> Column:
    """Train for buckets 0 to 7 of the code's hash, validation for 8, test for 9."""
    b = split_bucket(code)
    return F.when(b < 8, "train").when(b == 8, "validation").otherwise("test")


def holdout_label(code: Column, test: list[str] | None = None, val: list[str] | None = None) -> Column:
    return F.when(code.isin(test or HELD_OUT["test"]), "test").when(code.isin(val or HELD_OUT["val"]), "val").otherwise("train")


def chapter_url(root: str, version_id: Column, code: Column, number: Column, version_code: Column) -> Column:
    return F.concat(F.lit(f"{root}/"), version_id.cast("string"), F.lit("/"), code, F.lit("."), number.cast("string"), F.lit("."), version_code)


def side(versions: DataFrame, key: str | None) -> DataFrame:
    """The version of this key (trimmed, any case), or both in their order; an unknown key is an error."""
    if key is None:
        return versions
    wanted = key.strip().upper()
    found = versions.where(F.upper("key") == wanted)
    if found.isEmpty():
        raise KeyError(f"unknown version {key!r}")
    return found
