"""Small inputs and plain-Python answers for the tests of this folder."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def documents(spark, rows):
    """Rows ``(doc_id, text)`` or ``(doc_id, text, lang, source)`` as documents."""
    full = [(*row, "en", "a")[:2] + (row[2:4] if len(row) > 2 else ("en", "a")) for row in rows]
    return spark.createDataFrame(
        [(d, t, lang, s, None if t is None else len(t)) for d, t, lang, s in full], DOCUMENTS)


def sentence(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


class Sets:
    """Union-find that names a set by its smallest member."""

    def __init__(self, items):
        self.parent = {item: item for item in items}

    def find(self, item):
        while self.parent[item] != item:
            self.parent[item] = self.parent[self.parent[item]]
            item = self.parent[item]
        return item

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def rows_of(df, *names):
    return sorted((tuple(row[n] for n in names or df.columns) for row in df.collect()), key=repr)
