"""Text functions as Column expressions; Python only for what Spark lacks (NFC, HTML entities)."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Fixed value: the 29 white-space characters, as a regular expression class.
WS = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NBSP, ZWSP, REPLACEMENT = chr(0xA0), chr(0x200B), chr(0xFFFD)

#: The English stop words of the language check.
STOP_WORDS = """
a about above after again against all am an and any are as at be because been
before being below between both but by can did do does doing down during each
few for from further had has have having he her here hers herself him himself
his how i if in into is it its itself just me more most my myself no nor not
now of off on once only or other our ours ourselves out over own same she should
so some such than that the their theirs them themselves then there these they
this those through to too under until up very was we were what when where which
while who whom why will with you your yours yourself yourselves
""".split()
#: Fixed value: the punctuation around a token that the stop-word check ignores.
TOKEN_PUNCTUATION = ".,;:!?\"'()[]"


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(F.regexp_replace(c, f"^{WS}+", ""), rf"{WS}+\z", "")


def is_blank(c: Column) -> Column:
    """True for a text of white space only, and for an empty one; null for null."""
    return strip(c) == ""


def squeeze(c: Column) -> Column:
    """Runs of white space become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


@F.pandas_udf(ArrayType(StringType()))
def _nfc_each(s: pd.Series) -> pd.Series:
    return s.map(lambda xs: None if xs is None else [None if x is None else unicodedata.normalize("NFC", x) for x in xs])


@F.pandas_udf(StringType())
def _casefold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else x.casefold())


@F.pandas_udf(StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else html.unescape(x))


def nfc(c: Column) -> Column:
    """Unicode normal form C.  Spark has no such function; texts of ASCII only don't go to Python."""
    return F.coalesce(_nfc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def nfc_each(c: Column) -> Column:
    """The normal form of each element of an array; arrays of ASCII only don't go to Python."""
    return F.coalesce(_nfc_each(F.when(F.exists(c, lambda x: F.coalesce(x, F.lit("")).rlike(r"[^\x00-\x7F]")), c)), c)


def casefold(c: Column) -> Column:
    """Unicode case folding (sharp s becomes two letters, a final sigma a plain one); of ASCII it is lower case, which Python isn't asked for."""
    return F.coalesce(_casefold(F.when(c.rlike(r"[^\x00-\x7F]"), c)), F.lower(c))


def unescape(c: Column) -> Column:
    """HTML entities decoded, the replacement character an apostrophe, no-break spaces plain."""
    return F.translate(_unescape(c), REPLACEMENT + NBSP, "' ")


def clean_spaces(c: Column) -> Column:
    """No-break spaces plain, zero-width spaces gone."""
    return F.translate(c, NBSP + ZWSP, " ")


def normalize_text(c: Column) -> Column:
    """NFC, plain spaces, white space squeezed."""
    return squeeze(clean_spaces(nfc(c)))


def normalize_line(c: Column) -> Column:
    """NFC and plain spaces; runs of spaces, tabs and the like become one space, but line ends stay."""
    return strip(F.regexp_replace(clean_spaces(nfc(c)), r"[ \t\r\f\x0B]+", " "))


def normalize_lines(c: Column) -> Column:
    """Each element of an array normalized as a line is; null becomes the empty text."""
    return F.transform(nfc_each(c), lambda x: strip(F.regexp_replace(clean_spaces(F.coalesce(x, F.lit(""))), r"[ \t\r\f\x0B]+", " ")))


def tokens(c: Column) -> Column:
    """The distinct runs of ASCII letters and apostrophes of the lower-cased text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("([a-zA-Z']+)"), F.lit(1)))


def words(c: Column) -> Column:
    """The runs between white space."""
    return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")


def is_stop_word(token: Column) -> Column:
    return F.trim(F.lower(token), F.lit(TOKEN_PUNCTUATION)).isin(STOP_WORDS)


def stop_word_count(c: Column) -> Column:
    return F.size(F.filter(words(c), is_stop_word))


def round4(c: Column) -> Column:
    """Four decimals, halves to even, as thresholds compare them."""
    return F.bround(c, 4)


def stop_word_ratio(c: Column) -> Column:
    """The share of stop words among the words; 0 without words."""
    n = F.size(words(c))
    return F.when(n > 0, round4(stop_word_count(c) / n)).otherwise(0.0)


def sha256(c: Column) -> Column:
    return F.sha2(F.coalesce(c, F.lit("")), 256)


def digits(c: Column) -> Column:
    """The digits of a label as a number; 0 without any."""
    return F.coalesce(F.regexp_replace(c, "[^0-9]", "").try_cast("int"), F.lit(0))


def is_bracketed(c: Column) -> Column:
    return c.startswith("[") & c.endswith("]")


def merge_parts(parts: Column) -> Column:
    """An array of struct(text, note_before) as one text.

    A part is joined as it stands behind a note, or where either side of the seam
    has white space; otherwise by one space.  Empty parts don't count.
    """

    def step(acc: Column, p: Column) -> Column:
        t = F.coalesce(p["text"], F.lit(""))
        as_is = F.coalesce(p["note_before"], F.lit(False)) | F.substring(acc, -1, 1).rlike(WS) | F.substring(t, 1, 1).rlike(WS)
        return F.when(t == "", acc).when(acc == "", t).when(as_is, F.concat(acc, t)).otherwise(F.concat(acc, F.lit(" "), t))

    return F.aggregate(parts, F.lit(""), step)


#: Fixed value: how a page title names a version's code.
TITLE_CODE = r"\|[\x09-\x0D\x20]*([A-Za-z0-9]+)[\x09-\x0D\x20]+Bible\b"


def title_code(title: Column) -> Column:
    """The version code that a page title names; null if it names none."""
    return F.nullif(F.regexp_extract(title, TITLE_CODE, 1), F.lit(""))


def page_book_name(title: Column, h1: Column) -> Column:
    """The name before the number in the title's first part or else in the heading; null if neither has one."""
    name = lambda c: F.nullif(F.trim(F.regexp_extract(F.trim(c), r"^(.*)[ \t]+[0-9]+[a-z]?\z", 1)), F.lit(""))
    return F.coalesce(name(F.split(title, r"\|")[0]), name(h1))


def like_any_case(c: Column, part: str) -> Column:
    """Does the text contain ``part``, whatever the case of letters?"""
    return F.contains(F.lower(c), F.lower(F.lit(part)))


def hash_fraction(c: Column, salt: str = "") -> Column:
    """A whole number in 0 .. 999 from a text."""
    return F.pmod(F.conv(F.substring(F.sha2(F.concat(F.lit(salt), c), 256), 1, 8), 16, 10).cast("bigint"), F.lit(1000))


def now_iso() -> Column:
    """The time of the query in UTC, to the second, as ISO 8601; as a text, for records that keep it so."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
