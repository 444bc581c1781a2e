"""Reading a model's JSON answers strictly, as expressions over VARIANT.

One answer belongs to one batch. It either fails as a whole (``failure`` holds the code and
``failure_reason`` the text for every row of the batch) or gives ``items``, one per usable
entry of the JSON array, in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.functions.text import strip_code_fence
from civicloom.schemas import VALID_CODES

MISSING, INVALID, FAILED = "253", "254", "255"

# Reasons given where the answer has none to offer.
MISSING_REASON = "Missing result in JSON response"
UNREADABLE_REASON = "Failed to parse JSON response"
INVALID_REASON = "Invalid label returned by LLM"
FAILED_PREFIX = "API error: "

ITEM_TYPE = "array<struct<id:string,code:string,reasoning:string>>"


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _entry(entry: Column) -> Column:
    """The parts of one array entry; a missing key is null, a JSON null has the type VOID."""
    def member(key: str) -> Column:
        return F.try_variant_get(entry, f"$.{key}", "variant")

    return F.struct(
        F.schema_of_variant(member("id")).alias("id_type"),
        _text(member("id")).alias("id"),
        F.schema_of_variant(member("label")).alias("label_type"),
        _text(member("label")).alias("label"),
        member("reasoning").isNull().alias("silent"),
        _text(member("reasoning")).alias("reasoning"),
    )


def _id_text(entry: Column) -> Column:
    """An id as Python prints it, since ids are compared as text."""
    kind, plain = entry["id_type"], entry["id"]
    whole_decimal = kind.startswith("DECIMAL") & ~plain.contains(".")
    return (
        F.when(kind == "VOID", "None")
        .when(kind == "BOOLEAN", F.initcap(plain))
        .when(whole_decimal, F.concat(plain, F.lit(".0")))
        .otherwise(plain)
    )


def _item(entry: Column) -> Column:
    valid = entry["label_type"].isin("BIGINT", "STRING") & entry["label"].isin(*VALID_CODES)
    return F.struct(
        _id_text(entry).alias("id"),
        F.when(valid, entry["label"]).otherwise(INVALID).alias("code"),
        F.when(~valid, INVALID_REASON)
        .when(entry["silent"], "")
        .otherwise(entry["reasoning"])
        .alias("reasoning"),
    )


def read_answers(df: DataFrame, answer_col: str, error_col: str | None = None) -> DataFrame:
    """Adds ``failure``, ``failure_reason`` and ``items``. A null answer, or one with an error,
    is a failed call.

    ``try_parse_json`` overlooks text after the first value, so the text is read twice, as a
    member of an object and as an element of an array; only a single whole value fits both.
    Each reading is a column of its own, so that it happens once.
    """
    answer = F.col(answer_col)
    error = F.col(error_col) if error_col else F.lit(None).cast("string")
    texts = df.withColumn("_text", strip_code_fence(answer))
    read = texts.withColumns(
        {
            "_object": F.try_parse_json(F.concat(F.lit('{"a":'), "_text", F.lit(',"z":1}'))),
            "_array": F.try_parse_json(F.concat(F.lit("["), "_text", F.lit(",1]"))),
        }
    )
    whole = (F.try_variant_get("_object", "$.z", "int") == 1) & (
        F.try_variant_get("_array", "$[1]", "int") == 1
    )
    entries = F.try_variant_get("_object", "$.a", "array<variant>")
    parts = read.withColumns(
        {
            "_failed_call": answer.isNull() | error.isNotNull(),
            "_whole": F.coalesce(whole, F.lit(False)),
            "_entries": F.transform(entries, _entry),
        }
    )
    # A JSON text is a list, an object or a text by its first character; anything else cannot
    # be gone through entry by entry, which the caller sees as a failed call.
    iterable = F.substring("_text", 1, 1).isin("[", "{", '"')
    failed_call, unreadable = F.col("_failed_call"), ~F.col("_whole")
    usable = F.filter(
        "_entries", lambda entry: entry["id_type"].isNotNull() & entry["label_type"].isNotNull()
    )
    items = F.coalesce(F.transform(usable, _item), F.array().cast(ITEM_TYPE))
    call_reason = F.concat(F.lit(FAILED_PREFIX), F.coalesce(error, F.lit("no answer")))
    return parts.select(
        *df.columns,
        F.when(failed_call, FAILED)
        .when(unreadable, MISSING)
        .when(~iterable, FAILED)
        .alias("failure"),
        F.when(failed_call, call_reason)
        .when(unreadable, UNREADABLE_REASON)
        .when(~iterable, FAILED_PREFIX + "the answer is not a list")
        .alias("failure_reason"),
        F.when(~failed_call & F.col("_whole") & iterable, items).alias("items"),
    )


def answer_for(ticket_id: Column) -> Column:
    """``struct<code, reasoning>`` for one asked id, from the columns of ``read_answers``: the
    last entry with that id counts."""
    found = F.try_element_at(
        F.filter("items", lambda item: item["id"] == ticket_id.cast("string")), F.lit(-1)
    )
    failure = F.col("failure")
    return F.struct(
        F.coalesce(failure, found["code"], F.lit(MISSING)).alias("code"),
        F.when(failure.isNotNull(), F.col("failure_reason"))
        .when(found.isNull(), MISSING_REASON)
        .otherwise(found["reasoning"])
        .alias("reasoning"),
    )
