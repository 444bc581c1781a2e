"""Predicates and projections over whole tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from civicloom.operators.aggregate import status_counts
from civicloom.operators.filters import (
    coordinate_report,
    drop_sentinel_row,
    ensure_columns,
    filter_has_coordinates,
    filter_has_evidence,
    filter_known_districts,
    filter_province,
    filter_time_range,
    marker_rows,
    resolve_column,
    split_by_status,
    trim_column_names,
)
from civicloom.queries.registry import (
    LABELED_DOCUMENTS,
    labeled_documents,
    query,
)

RANGE = (datetime(2024, 1, 10), datetime(2024, 1, 20, 12, 30))


@query(
    "filter_time_range",
    """SELECT event_id, ts, event_type FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20 12:30:00'""",
)
def _filter_time_range(t):
    return filter_time_range(t.events, *RANGE, "ts").select("event_id", "ts", "event_type")


@query(
    "filter_province",
    """SELECT c_custkey, c_name, n_name, r_name
       FROM customer JOIN nation ON n_nationkey = c_nationkey
       JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA'""",
)
def _filter_province(t):
    located = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).join(
        t.region, F.col("r_regionkey") == F.col("n_regionkey")
    )
    return filter_province(located, "r_name", "ASIA").select(
        "c_custkey", "c_name", "n_name", "r_name"
    )


@query(
    "trim_column_names",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
)
def _trim_column_names(t):
    padded = t.lineitem.select(
        F.col("l_orderkey").alias(" l_orderkey"),
        F.col("l_linenumber").alias("l_linenumber  "),
        F.col("l_quantity").alias("\tl_quantity "),
    )
    return trim_column_names(padded)


@query(
    "ensure_columns",
    """SELECT conv_id, turn, role, 'ไม่ระบุ' AS type,
              'ticket_' || (row_number() OVER (ORDER BY conv_id, turn) - 1) AS ticket_id
       FROM conversations""",
)
def _ensure_columns(t):
    bare = t.conversations.select("conv_id", "turn", "role")
    return ensure_columns(bare, ["conv_id", "turn"])


@query(
    "resolve_column",
    "SELECT c_custkey, c_name AS exact_name, c_mktsegment AS by_token, c_nationkey AS by_place "
    "FROM customer",
)
def _resolve_column(t):
    customer = t.customer
    return customer.select(
        "c_custkey",
        F.col(resolve_column(customer, "c_name")).alias("exact_name"),
        F.col(resolve_column(customer, "organization", tokens=["Segment"])).alias("by_token"),
        F.col(resolve_column(customer, "area", tokens=["district"], position=2)).alias("by_place"),
    )


@query(
    "filter_has_evidence",
    """SELECT * FROM (SELECT d.doc_id, CASE WHEN quality = 1 THEN text END AS comment,
                             CASE WHEN lang = 'en' THEN source END AS photo
                      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
       WHERE comment IS NOT NULL OR photo IS NOT NULL""",
)
def _filter_has_evidence(t):
    rows = labeled_documents(t).select(
        "doc_id",
        F.when(F.col("quality") == 1, F.col("text")).alias("comment"),
        F.when(F.col("lang") == "en", F.col("source")).alias("photo"),
    )
    return filter_has_evidence(rows)


@query(
    "drop_sentinel_row",
    "SELECT o_orderkey AS _id, o_orderstatus FROM orders WHERE o_orderkey <> 1",
)
def _drop_sentinel_row(t):
    return drop_sentinel_row(t.orders.select(F.col("o_orderkey").alias("_id"), "o_orderstatus"))


@query(
    "filter_known_districts",
    """SELECT c_custkey, amp_th, amp_en FROM
         (SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS amp_th,
                 CASE WHEN c_acctbal < 5000 THEN 'NATION_' || c_nationkey ELSE '?' END AS amp_en
          FROM customer)
       WHERE amp_en IN (SELECT n_name FROM nation JOIN region ON r_regionkey = n_regionkey
                        WHERE r_name IN ('ASIA', 'EUROPE'))
          OR amp_th IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation
                        JOIN region ON r_regionkey = n_regionkey
                        WHERE r_name IN ('EUROPE', 'AFRICA'))""",
)
def _filter_known_districts(t):
    rows = t.customer.select(
        "c_custkey",
        F.col("c_nationkey").cast("string").alias("amp_th"),
        F.when(F.col("c_acctbal") < 5000, F.concat(F.lit("NATION_"), "c_nationkey"))
        .otherwise("?")
        .alias("amp_en"),
    )
    placed = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    known = placed.filter(F.col("r_name").isin("ASIA", "EUROPE", "AFRICA")).select(
        F.when(F.col("r_name") != "ASIA", F.col("n_nationkey").cast("string")).alias("amp_th"),
        F.when(F.col("r_name") != "AFRICA", F.col("n_name")).alias("amp_en"),
    )
    return filter_known_districts(rows, known)


@query(
    "split_by_status",
    f"""WITH {LABELED_DOCUMENTS} SELECT doc_id, llm_label,
          CASE WHEN llm_label IS NULL THEN 'new' WHEN llm_label = 'API Error' THEN 'retry'
               ELSE 'cached' END AS status FROM complaints""",
)
def _split_by_status(t):
    return split_by_status(labeled_documents(t).select("doc_id", "llm_label"))


@query(
    "status_counts",
    f"""WITH {LABELED_DOCUMENTS} SELECT
          count(*) FILTER (llm_label IS NOT NULL AND llm_label <> 'API Error') AS cached,
          count(*) FILTER (llm_label IS NULL) AS new,
          count(*) FILTER (llm_label = 'API Error') AS retry,
          count(*) FILTER (llm_label IS NULL OR llm_label = 'API Error') AS pending
        FROM complaints""",
)
def _status_counts(t):
    return status_counts(labeled_documents(t))


def places(t):
    """Customers as places; coordinates only where the balance is not negative."""
    there = F.col("c_acctbal") >= 0
    return t.customer.select(
        "c_custkey",
        "c_name",
        F.when(there, F.col("c_acctbal")).alias("latitude"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey").cast("double")).alias(
            "longitude"
        ),
        F.concat(F.lit("02-"), "c_nationkey").alias("phone"),
    )


PLACES = """
    places AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS latitude,
                      CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_nationkey AS DOUBLE) END
                          AS longitude,
                      '02-' || c_nationkey AS phone FROM customer)
"""


@query(
    "filter_has_coordinates",
    f"WITH {PLACES} SELECT * FROM places WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
)
def _filter_has_coordinates(t):
    return filter_has_coordinates(places(t))


@query(
    "coordinate_report",
    f"""WITH {PLACES} SELECT count(*) AS rows,
               count(*) FILTER (latitude IS NOT NULL AND longitude IS NOT NULL) AS located,
               count(*) > 0 AND count(*) FILTER (latitude IS NOT NULL AND longitude IS NOT NULL) = 0
                   AS none_located FROM places""",
)
def _coordinate_report(t):
    return coordinate_report(places(t))


@query(
    "marker_rows",
    f"""WITH {PLACES} SELECT latitude, longitude, c_name AS name, phone FROM places
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
)
def _marker_rows(t):
    return marker_rows(places(t), "Hospital Name (English)", "Telephone", 1, -1)


