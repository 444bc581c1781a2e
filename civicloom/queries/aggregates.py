"""Counts, shares, label statistics, bins, and top lists over whole tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from civicloom.operators.aggregate import (
    classification_breakdown,
    count_by_key,
    count_with_share,
    coverage_counts,
    dataset_summary,
    group_sizes,
    guarded_take,
    label_pivot,
    last_wins_dedupe,
    normalized_distribution,
    null_profile,
    order_by_time,
    overall_label_stats,
    population_totals,
    preview,
    relative_bins,
    severity_score,
    time_bounds,
    top_k_by_count,
    top_k_rows,
)
from civicloom.operators.filters import filter_time_range
from civicloom.queries.filters import PLACES, places
from civicloom.queries.registry import LABELED_DOCUMENTS, labeled_documents, query
from civicloom.schemas import QUARTER_BINS


def incidents(t):
    """Orders as incidents in the customer's nation; none for customers of one segment."""
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.when(
            F.col("c_mktsegment") != "BUILDING", F.concat(F.lit("NATION_"), "c_nationkey")
        ).alias("district"),
    )


INCIDENTS = """
    incidents AS (SELECT o_orderkey, CASE WHEN c_mktsegment <> 'BUILDING'
                                          THEN 'NATION_' || c_nationkey END AS district
                  FROM orders JOIN customer ON c_custkey = o_custkey)
"""


@query(
    "count_by_key",
    f"""WITH {INCIDENTS} SELECT district, count(*) AS n FROM incidents
        WHERE district IS NOT NULL GROUP BY district""",
)
def _count_by_key(t):
    return count_by_key(incidents(t), "district")


@query(
    "count_with_share",
    f"""WITH {INCIDENTS} SELECT * FROM
          (SELECT district, count(*) AS n,
                  count(*)::DOUBLE / (SELECT count(*) FROM incidents) * 100 AS percentage
           FROM incidents GROUP BY district) WHERE district IS NOT NULL""",
)
def _count_with_share(t):
    return count_with_share(incidents(t), "district")


@query(
    "normalized_distribution",
    f"""WITH {LABELED_DOCUMENTS}
        SELECT coalesce(CAST(quality AS VARCHAR), 'MISSING') AS stratum, count(*) AS n,
               count(*)::DOUBLE / (SELECT count(*) FROM complaints) AS share
        FROM complaints GROUP BY 1""",
)
def _normalized_distribution(t):
    return normalized_distribution(labeled_documents(t), "quality")


@query("time_bounds", "SELECT min(ts) AS min_ts, max(ts) AS max_ts FROM events")
def _time_bounds(t):
    return time_bounds(t.events, "ts", datetime(2023, 1, 1), datetime(2024, 1, 1))


@query(
    "null_profile",
    f"""WITH {PLACES} SELECT count(*) - count(c_custkey) AS c_custkey,
          count(*) - count(c_name) AS c_name, count(*) - count(latitude) AS latitude,
          count(*) - count(longitude) AS longitude, count(*) - count(phone) AS phone FROM places""",
)
def _null_profile(t):
    return null_profile(places(t))


@query(
    "dataset_summary",
    """SELECT 'customer' AS dataset, count(*) AS row_count,
              'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS columns FROM customer
       UNION ALL SELECT 'events', count(*), 'event_id,ts,user_id,event_type,value,props' FROM events
       UNION ALL SELECT 'labels', count(*), 'doc_id,quality,toxic' FROM labels""",
)
def _dataset_summary(t):
    return dataset_summary({"customer": t.customer, "events": t.events, "labels": t.labels})


@query(
    "label_pivot",
    f"""WITH {LABELED_DOCUMENTS} SELECT source,
          count(*) FILTER (llm_label = 'Not Sufficient') AS "Not Sufficient",
          count(*) FILTER (llm_label = 'Sufficient') AS "Sufficient",
          count(*) FILTER (llm_label = 'Uncertain (has partial evidence)')
              AS "Uncertain (has partial evidence)",
          count(*) FILTER (llm_label = 'Missing in JSON Response') AS "Missing in JSON Response",
          count(*) FILTER (llm_label = 'Invalid Label from LLM') AS "Invalid Label from LLM",
          count(*) FILTER (llm_label = 'API Error') AS "API Error",
          count(*) FILTER (llm_label = 'Unknown') AS "Unknown"
        FROM complaints WHERE source IS NOT NULL AND llm_label IS NOT NULL GROUP BY source""",
)
def _label_pivot(t):
    return label_pivot(labeled_documents(t), "source", "llm_label")


SEVERITY = """3.0::DOUBLE * count(*) FILTER (llm_label = 'Not Sufficient')
            + 2.5::DOUBLE * count(*) FILTER (llm_label = 'API Error')
            + 1.5::DOUBLE * count(*) FILTER (llm_label = 'Uncertain (has partial evidence)')
            + 0.5::DOUBLE * count(*) FILTER (llm_label = 'Sufficient')"""
LABEL_COUNTS = """
          count(*) FILTER (llm_label = 'Sufficient') AS sufficient,
          count(*) FILTER (llm_label = 'Not Sufficient') AS not_sufficient,
          count(*) FILTER (llm_label = 'Uncertain (has partial evidence)') AS uncertain,
          count(*) FILTER (llm_label = 'API Error') AS api_error"""


@query(
    "severity_score",
    f"""WITH {LABELED_DOCUMENTS} SELECT source, {SEVERITY} AS severity_score
        FROM complaints WHERE source IS NOT NULL AND llm_label IS NOT NULL GROUP BY source""",
)
def _severity_score(t):
    return severity_score(labeled_documents(t), "source", "llm_label")


@query(
    "severity_score_guarded",
    f"""WITH {LABELED_DOCUMENTS},
          relabeled AS (SELECT source, 'as is' AS kind, llm_label FROM complaints
                        UNION ALL SELECT source, 'none', replace(llm_label, 'Not Sufficient', 'Sufficient')
                        FROM complaints)
        SELECT source, kind, CASE WHEN max(count(*) FILTER (llm_label = 'Not Sufficient'))
                                       OVER (PARTITION BY kind) > 0 THEN {SEVERITY} ELSE 0 END AS severity_score
        FROM relabeled WHERE source IS NOT NULL AND llm_label IS NOT NULL GROUP BY source, kind""",
)
def _severity_score_guarded(t):
    """All rows, once with the label that opens the guard and once with it renamed."""
    rows = labeled_documents(t)
    renamed = rows.withColumn("llm_label", F.replace("llm_label", F.lit("Not Sufficient"), F.lit("Sufficient")))
    as_is, none = (
        severity_score(df, "source", "llm_label", only_with_not_sufficient=True) for df in (rows, renamed)
    )
    return as_is.withColumn("kind", F.lit("as is")).unionByName(none.withColumn("kind", F.lit("none")))


@query(
    "classification_breakdown",
    f"""WITH {LABELED_DOCUMENTS} SELECT source, {LABEL_COUNTS}, count(*) AS total,
               {SEVERITY} AS severity_score
        FROM complaints WHERE source IS NOT NULL AND llm_label IS NOT NULL GROUP BY source""",
)
def _classification_breakdown(t):
    return classification_breakdown(labeled_documents(t), "source", "llm_label")


@query(
    "overall_label_stats",
    f"""WITH {LABELED_DOCUMENTS}
        SELECT label, count(llm_label) AS n,
               count(llm_label)::DOUBLE / (SELECT count(*) FROM complaints) * 100 AS percentage
        FROM (VALUES ('Sufficient'), ('Not Sufficient'), ('Uncertain (has partial evidence)'),
                     ('API Error')) AS known(label)
        LEFT JOIN complaints ON llm_label = label GROUP BY label""",
)
def _overall_label_stats(t):
    return overall_label_stats(labeled_documents(t), "llm_label")


def population(t):
    """Customers per nation as residents, parted by the sign of the balance."""
    male = F.col("c_acctbal") < 4000
    return t.customer.groupBy(F.concat(F.lit("NATION_"), "c_nationkey").alias("DISTRICT")).agg(
        F.count("*").alias("TOTAL"),
        F.count_if(male).alias("MALE"),
        F.count_if(~male).alias("FEMALE"),
    )


POPULATION = """
    population AS (SELECT 'NATION_' || c_nationkey AS DISTRICT, count(*) AS TOTAL,
                          count(*) FILTER (c_acctbal < 4000) AS MALE,
                          count(*) FILTER (c_acctbal >= 4000) AS FEMALE
                   FROM customer GROUP BY c_nationkey)
"""


@query(
    "population_totals",
    f"""WITH {POPULATION} SELECT sum(TOTAL)::BIGINT AS total, sum(MALE)::BIGINT AS male,
               sum(FEMALE)::BIGINT AS female, trunc(avg(TOTAL))::BIGINT AS average,
               max(TOTAL) AS largest FROM population""",
)
def _population_totals(t):
    return population_totals(population(t))


@query(
    "last_wins_dedupe",
    """SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts
       FROM events GROUP BY user_id, event_type""",
)
def _last_wins_dedupe(t):
    rows = t.events.select("user_id", "event_type", "event_id", "ts")
    return last_wins_dedupe(rows, ["user_id", "event_type"], ["ts", "event_id"])


def _bin_sql(value: str, cuts: tuple[float, ...]) -> str:
    whens = " ".join(
        f"WHEN {value} < (SELECT max({value}) FROM sizes) * {cut}::DOUBLE THEN {number}"
        for number, cut in enumerate(cuts, 1)
    )
    return f"CAST(CASE WHEN {value} = 0 THEN 0 {whens} ELSE {len(cuts) + 1} END AS INTEGER)"


@query(
    "relative_bins",
    f"""WITH {INCIDENTS}, sizes AS (SELECT district, count(*) AS n FROM incidents
                                    WHERE district IS NOT NULL GROUP BY district)
        SELECT district, n, {_bin_sql("n", (0.25, 0.5, 0.75))} AS quarter_bin,
               {_bin_sql("n", (0.2, 0.4, 0.6, 0.8))} AS fifth_bin FROM sizes""",
)
def _relative_bins(t):
    sizes = group_sizes(incidents(t), "district")
    return relative_bins(relative_bins(sizes, "n", QUARTER_BINS, "quarter_bin"), "n", name="fifth_bin")


@query(
    "coverage_counts",
    f"""WITH {PLACES} SELECT count(*) AS total,
               count(*) FILTER (latitude IS NOT NULL AND longitude IS NOT NULL) AS located,
               count(*) FILTER (phone <> '') AS with_phone FROM places""",
)
def _coverage_counts(t):
    return coverage_counts(places(t), "phone")


@query("order_by_time", "SELECT event_id, ts, event_type FROM events")
def _order_by_time(t):
    return order_by_time(t.events.select("event_id", "ts", "event_type"), "ts", "event_id")


@query("guarded_take_whole", "SELECT event_id, ts, event_type FROM events")
def _guarded_take_whole(t):
    rows = t.events.select("event_id", "ts", "event_type")
    return guarded_take(rows, "ts", "event_id", max_rows=rows.count())


@query(
    "guarded_take",
    """SELECT event_id, ts, event_type FROM events
       WHERE ts >= TIMESTAMP '2024-01-05' ORDER BY ts, event_id LIMIT 1000""",
)
def _guarded_take(t):
    late = filter_time_range(t.events, datetime(2024, 1, 5), datetime(2025, 1, 1), "ts")
    return guarded_take(late.select("event_id", "ts", "event_type"), "ts", "event_id", force=True)


@query(
    "top_k_by_count",
    f"""WITH {INCIDENTS} SELECT district, count(*) AS n FROM incidents
        WHERE district IS NOT NULL GROUP BY district ORDER BY n DESC, district LIMIT 5""",
)
def _top_k_by_count(t):
    return top_k_by_count(incidents(t), "district")


@query(
    "top_k_not_sufficient",
    f"""WITH {LABELED_DOCUMENTS} SELECT source, count(*) AS n FROM complaints
        WHERE llm_label = 'Not Sufficient' GROUP BY source ORDER BY n DESC, source LIMIT 5""",
)
def _top_k_not_sufficient(t):
    unsolved = labeled_documents(t).filter(F.col("llm_label") == "Not Sufficient")
    return top_k_by_count(unsolved, "source")


@query(
    "top_k_rows",
    f"WITH {POPULATION} SELECT * FROM population ORDER BY TOTAL DESC, DISTRICT LIMIT 5",
)
def _top_k_rows(t):
    return top_k_rows(population(t), "TOTAL", "DISTRICT")


@query("preview", "SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 20")
def _preview(t):
    return preview(t.events.select("event_id", "ts", "value"), ["ts", "event_id"])
