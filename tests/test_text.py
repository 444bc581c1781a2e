import random
import re

import pytest
from pyspark.sql import functions as F

from civicloom.functions.numbers import percent_1dp, relative_bin, thousands
from civicloom.functions.text import (
    clean_text,
    parse_timestamp,
    present_flag,
    star_text,
    strip_blanks,
    strip_code_fence,
)

CLEANED = [
    (None, None),
    ("", ""),
    ("   ", ""),
    ("see http://a.b/c?d now", "see now"),
    ("www.x.y", ""),
    ("www.", "www"),
    ("http", "http"),
    ("ไฟ🔥ดับ", "ไฟดับ"),
    ("ab中cd", "abcd"),
    ("café bar", "caf bar"),
    ("a🤀b", "a b"),
    ("๙๚", "๙"),
    ("http://a b", "b"),
]


def apply(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [row[0] for row in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_clean_text_edge_rows(spark):
    assert apply(spark, [text for text, _ in CLEANED], clean_text) == [out for _, out in CLEANED]


def is_symbol(char):
    ranges = ((0x1F600, 0x1F64F), (0x1F300, 0x1F5FF), (0x1F680, 0x1F6FF), (0x1F1E0, 0x1F1FF),
              (0x2500, 0x2BEF), (0x2702, 0x27B0), (0x24C2, 0x1F251))
    return any(low <= ord(char) <= high for low, high in ranges)


def cleaned_by_hand(text):
    text = re.sub(r"http\S+|www\.\S+", "", text)
    text = "".join(char for char in text if not is_symbol(char))
    kept = (c if c.isascii() and c.isalnum() or "ก" <= c <= "๙" else " " for c in text)
    return " ".join("".join(kept).split())


def test_clean_text_against_plain_python(spark):
    rng = random.Random(7)
    parts = ["http", "http://", "www.", "x", "Z9", "ไฟ", "๙", "๚", "🔥", "中", "가", "é", "́", "　",
             " ", "\x85", "\x1c", " ", "\n", "\t", ".", "-", "🤀", "Ⓛ", "Ⓜ", "\U0001f251",
             "\U0001f252", "⯯", "⯰", "_", "ﾃ"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(4000)]
    assert apply(spark, texts, clean_text) == [cleaned_by_hand(text) for text in texts]


def test_strip_blanks(spark):
    texts = ["  a b　\n", "\n\t", "", "x", " y", "z\x85", "a" + " " * 50000 + "b"]
    assert apply(spark, texts, strip_blanks) == [text.strip() for text in texts]


@pytest.mark.parametrize(
    "text, body",
    [
        ("```json\n[1]\n``` tail", "[1]"),
        ("x ``` [2] ``` y ```json [3] ```", "[3]"),
        ("a ```\n[4]", "[4]"),
        ("\n [5] \n", "[5]"),
    ],
)
def test_strip_code_fence(spark, text, body):
    assert apply(spark, [text], strip_code_fence) == [body]


def test_star_text(spark):
    stars = ["4", " 4.5 ", "4 stars", "", None, "1e1", "4f", "-2", ".5"]
    shown = ["4.0/5", "4.5/5", None, None, None, "10.0/5", None, "-2.0/5", "0.5/5"]
    assert apply(spark, stars, star_text) == shown


def test_present_flag(spark):
    assert apply(spark, [None, "", " 　\n", "x"], present_flag) == [False, False, False, True]


def test_parse_timestamp(spark):
    texts = [None, "2024-02-30", "2024-01-02 03:04:05", "soon"]
    days = apply(spark, texts, lambda c: parse_timestamp(c).cast("string"))
    assert days == [None, None, "2024-01-02 03:04:05", None]


def test_percent_matches_python(spark):
    rng = random.Random(3)
    values = [count / total * 100 for total in (2000, 1600, 400, 7, 64) for count in range(0, total + 1, 3)]
    values += [rng.uniform(0, 1000) for _ in range(2000)] + [0.05, 0.15, 0.25, 0.35, 0.45, 12.25, 100.0]
    values += [(2 * k + 1) / 20 for k in range(3000)] + [-0.35, -12.25, -3.0]
    assert apply(spark, values, percent_1dp, "double") == [f"{value:.1f}%" for value in values]


def test_thousands(spark):
    assert apply(spark, [0, 999, 1234567], thousands, "bigint") == ["0", "999", "1,234,567"]


@pytest.mark.parametrize(
    "largest, cuts, bins",
    [
        (8, (0.25, 0.5, 0.75), [0, 1, 2, 3, 4, 4]),
        (10, (0.2, 0.4, 0.6, 0.8), [0, 1, 2, 3, 4, 5]),
    ],
)
def test_relative_bin(spark, largest, cuts, bins):
    values = [0, 1, 2, 4, 6, 8]
    assert apply(spark, values, lambda c: relative_bin(c, F.lit(largest), cuts), "int") == bins
