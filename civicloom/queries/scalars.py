"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicloom.functions.labels import label_description
from civicloom.functions.numbers import percent_1dp, thousands
from civicloom.functions.text import (
    SYMBOL_PATTERN,
    THAI_RANGE,
    UNICODE_BLANKS,
    URL_PATTERN,
    clean_text,
    parse_timestamp,
    present_flag,
    range_label,
    star_text,
    strip_code_fence,
)
from civicloom.queries.registry import LABELED_DOCUMENTS, labeled_documents, query
from civicloom.session import spread

TAIL = " see http://a.b/c?d now ไฟ🔥ดับ ab中cd café! www.x.y ☎ www."


def clean_sql(text: str) -> str:
    others = f"[^a-zA-Z0-9{THAI_RANGE}]+"
    for pattern, other in ((URL_PATTERN, ""), (SYMBOL_PATTERN, ""), (others, " ")):
        text = f"regexp_replace({text}, '{pattern}', '{other}', 'g')"
    return f"trim({text})"


@query(
    "clean_text",
    f"SELECT doc_id, {clean_sql(f"text || '{TAIL}'")} AS cleaned FROM documents",
)
def _clean_text(t):
    return spread(t.documents.select("doc_id", "text"), t.spark.sparkContext.defaultParallelism).select(
        "doc_id", clean_text(F.concat("text", F.lit(TAIL))).alias("cleaned")
    )


@query(
    "label_description",
    f"WITH {LABELED_DOCUMENTS} SELECT doc_id, coalesce(llm_label, 'Unknown') AS description "
    "FROM complaints",
)
def _label_description(t):
    return labeled_documents(t).select(
        "doc_id", label_description(F.col("code")).alias("description")
    )


@query(
    "strip_code_fence",
    f"""SELECT conv_id, turn,
               regexp_replace(text, '^[{UNICODE_BLANKS}]+|[{UNICODE_BLANKS}]+$', '', 'g') AS body
        FROM conversations""",
)
def _strip_code_fence(t):
    text, role = F.col("text"), F.col("role")
    answer = (
        F.when(role == "user", F.concat(F.lit("Sure:\n```json\n"), text, F.lit("\n```\ndone")))
        .when(role == "assistant", F.concat(F.lit("```\n"), text, F.lit("\n``` and more")))
        .otherwise(F.concat(F.lit("\n "), text, F.lit("　\n")))
    )
    return t.conversations.select("conv_id", "turn", strip_code_fence(answer).alias("body"))


@query(
    "star_text",
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS VARCHAR) || '/5' END AS star
       FROM lineitem""",
)
def _star_text(t):
    star = F.when(F.col("l_returnflag") == "R", "4 of 5").otherwise(
        F.concat(F.lit(" "), F.col("l_quantity").cast("string"))
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", star_text(star).alias("star"))


@query(
    "present_flag",
    """SELECT c_custkey, c_acctbal >= 0 AND c_mktsegment <> 'BUILDING' AS present FROM customer""",
)
def _present_flag(t):
    photo = F.when(F.col("c_acctbal") < 0, None).otherwise(
        F.when(F.col("c_mktsegment") == "BUILDING", " \t\n　").otherwise(F.col("c_name"))
    )
    return t.customer.select("c_custkey", present_flag(photo).alias("present"))


@query(
    "thousands",
    "SELECT o_orderkey, format('{:,}', o_orderkey * 7919) AS shown FROM orders",
)
def _thousands(t):
    return t.orders.select("o_orderkey", thousands(F.col("o_orderkey") * 7919).alias("shown"))


@query(
    "percent_1dp",
    """SELECT o_orderkey,
              format('{:.1f}%', o_custkey / 2000.0::DOUBLE * 100) AS of_all,
              format('{:.1f}%', o_totalprice / 4000.0::DOUBLE) AS of_price
       FROM orders""",
)
def _percent_1dp(t):
    return t.orders.select(
        "o_orderkey",
        percent_1dp(F.col("o_custkey") / F.lit(2000.0) * 100).alias("of_all"),
        percent_1dp(F.col("o_totalprice") / F.lit(4000.0)).alias("of_price"),
    )


@query(
    "range_label",
    """SELECT o_orderkey, 'labeled_output_' || strftime(o_orderdate, '%m%d%Y') || '_'
              || strftime(o_orderdate + INTERVAL 7 DAY, '%m%d%Y') AS label
       FROM orders""",
)
def _range_label(t):
    start = F.col("o_orderdate")
    end = start + F.expr("INTERVAL 7 DAYS")
    return t.orders.select("o_orderkey", range_label(start, end).alias("label"))


@query(
    "parse_timestamp",
    """SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view') THEN ts END AS ts FROM events""",
)
def _parse_timestamp(t):
    text = (
        F.when(F.col("event_type") == "error", "no time")
        .when(F.col("event_type") == "view", None)
        .otherwise(F.col("ts").cast("string"))
    )
    return t.events.select("event_id", parse_timestamp(text).cast("timestamp_ntz").alias("ts"))
