"""Label codes, label states and the severity weights."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicloom.schemas import LABEL_TEXT, RETRY_LABELS, SEVERITY_WEIGHTS, UNKNOWN_LABEL


def label_description(code: Column) -> Column:
    """Text of a code; codes nobody knows, null among them, are ``Unknown``."""
    texts = F.create_map(*[F.lit(part) for part in chain.from_iterable(LABEL_TEXT.items())])
    return F.coalesce(F.try_element_at(texts, code.cast("string")), F.lit(UNKNOWN_LABEL))


def label_status(label: Column) -> Column:
    """``new`` without a label, ``retry`` after an error, else ``cached``."""
    return (
        F.when(label.isNull(), "new").when(label.isin(*RETRY_LABELS), "retry").otherwise("cached")
    )


def severity(counts: dict[str, Column]) -> Column:
    """Weighted sum of label counts."""
    parts = [counts[label] * F.lit(weight) for label, weight in SEVERITY_WEIGHTS.items()]
    return reduce(lambda a, b: a + b, parts)
