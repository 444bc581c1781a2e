"""Text expressions; all of them stay on the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks as Python's ``\s`` and ``str.strip`` know them (Java's know ASCII only).
UNICODE_BLANKS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# Symbol ranges that vanish without leaving a blank. The first, wide one holds box
# drawing, dingbats and flags, and also CJK and Hangul.
SYMBOL_RANGES = r"\x{24C2}-\x{1F251}\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}"
# The Thai letters and digits that count as text, beside ASCII letters and digits.
THAI_RANGE = r"\x{0E01}-\x{0E59}"

URL_PATTERN = f"http[^{UNICODE_BLANKS}]+|www\\.[^{UNICODE_BLANKS}]+"
SYMBOL_PATTERN = f"[{SYMBOL_RANGES}]+"
# The POSIX class is one test where a-zA-Z0-9 would be three in a chain; with the chain, tasks
# that share a JVM slow each other down to the pace of one.
OTHER_PATTERN = f"[^\\p{{Alnum}}{THAI_RANGE}]+"

FENCE = "```"


def clean_text(text: Column) -> Column:
    """Drop URLs and symbols, turn all else but Thai, Latin and digits into single blanks.

    Each pass is one regular expression over the whole text; the first is taken only by texts
    that can hold a URL, the second only by texts beyond ASCII.
    """
    may_hold_url = text.contains("http") | text.contains("www.")
    no_urls = F.when(may_hold_url, F.regexp_replace(text, URL_PATTERN, "")).otherwise(text)
    beyond_ascii = F.octet_length(no_urls) != F.char_length(no_urls)
    no_symbols = F.when(beyond_ascii, F.regexp_replace(no_urls, SYMBOL_PATTERN, "")).otherwise(
        no_urls
    )
    return F.trim(F.regexp_replace(no_symbols, OTHER_PATTERN, " "))


def strip_blanks(text: Column) -> Column:
    """Cut Unicode blanks, line breaks included, off both ends. Only texts that begin or end
    with a blank are searched, and those from the end back to the last other character."""
    blank, other = f"[{UNICODE_BLANKS}]", f"[^{UNICODE_BLANKS}]"
    first, last = F.substring(text, 1, 1), F.substring(text, -1, 1)
    kept = F.regexp_extract(text, f"(?s)^{blank}*+(.*{other})", 1)
    return F.when(first.rlike(blank) | last.rlike(blank), kept).otherwise(text)


def strip_code_fence(text: Column) -> Column:
    """What stands between the first fence (a json fence first) and the next one."""
    def fenced(opening: str) -> Column:
        return strip_blanks(
            F.split_part(F.split_part(text, F.lit(opening), F.lit(2)), F.lit(FENCE), F.lit(1))
        )

    return (
        F.when(text.contains(f"{FENCE}json"), fenced(f"{FENCE}json"))
        .when(text.contains(FENCE), fenced(FENCE))
        .otherwise(strip_blanks(text))
    )


def present_flag(text: Column) -> Column:
    """True if there is a text and it is not blank: the search ends at the first other character."""
    return F.coalesce(text.rlike(f"[^{UNICODE_BLANKS}]"), F.lit(False))


def star_text(star: Column, numeric: bool = False) -> Column:
    """``x/5`` for a numeric rating, null for any other. ``numeric`` says that the column holds
    numbers, which are then not read from text."""
    if numeric:
        return F.concat(star.cast("double").cast("string"), F.lit("/5"))
    number = r"([+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?)"
    blanks = f"[{UNICODE_BLANKS}]*"
    found = F.regexp_extract(star.cast("string"), f"^{blanks}{number}{blanks}$", 1)
    return F.concat(found.try_cast("double").cast("string"), F.lit("/5"))


def mentions_any(text: Column, words: tuple[str, ...]) -> Column:
    """True if the text holds at least one of the words."""
    return reduce(lambda seen, word: seen | text.contains(word), words[1:], text.contains(words[0]))


def parse_timestamp(value: Column, fmt: str | None = None) -> Column:
    """Text to timestamp; null and unreadable text give null."""
    return F.try_to_timestamp(value, F.lit(fmt)) if fmt else F.try_to_timestamp(value)


def range_label(start: Column, end: Column, prefix: str = "labeled_output") -> Column:
    """Name of an export of the time range: ``prefix_MMddyyyy_MMddyyyy``."""
    return F.concat_ws(
        "_", F.lit(prefix), F.date_format(start, "MMddyyyy"), F.date_format(end, "MMddyyyy")
    )
