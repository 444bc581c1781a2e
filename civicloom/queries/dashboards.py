"""The dashboard's district tables and the flagship ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicloom.operators.aggregate import classification_breakdown, relative_bins
from civicloom.plans.dashboard import (
    classification_by_district,
    incidents_by_district,
    issues_by_district,
    population_by_district,
)
from civicloom.queries.aggregates import (
    INCIDENTS,
    LABEL_COUNTS,
    POPULATION,
    SEVERITY,
    _bin_sql,
    incidents,
    population,
)
from civicloom.queries.registry import (
    LABELED_DOCUMENTS,
    NATION_DISTRICTS,
    labeled_documents,
    nation_districts,
    query,
)
from civicloom.schemas import FIFTH_BINS


def _bins_against(value: str, largest: str, cuts: tuple[float, ...]) -> str:
    return _bin_sql(value, cuts).replace(f"(SELECT max({value}) FROM sizes)", largest)


@query(
    "severity_ranking",
    f"""WITH {LABELED_DOCUMENTS}, sizes AS (
          SELECT source, {LABEL_COUNTS}, count(*) AS total, {SEVERITY} AS severity_score
          FROM complaints WHERE source IS NOT NULL AND llm_label IS NOT NULL GROUP BY source)
        SELECT *, {_bin_sql("severity_score", (0.2, 0.4, 0.6, 0.8))} AS bin FROM sizes""",
)
def severity_ranking(t):
    """Sources by severity of their complaints: label join, breakdown, score, bin, order."""
    counted = classification_breakdown(labeled_documents(t), "source", "llm_label")
    binned = relative_bins(counted, "severity_score", FIFTH_BINS)
    return binned.orderBy(F.desc("severity_score"), "source")


@query(
    "incidents_by_district",
    f"""WITH {NATION_DISTRICTS}, {INCIDENTS},
          sizes AS (SELECT district, count(*) AS incidents FROM incidents
                    WHERE district IS NOT NULL GROUP BY district)
        SELECT amp_th, amp_en, incidents,
               {_bins_against("incidents", "(SELECT max(incidents) FROM sizes)", (0.25, 0.5, 0.75))}
                   AS bin
        FROM (SELECT amp_th, amp_en, coalesce(incidents, 0) AS incidents
              FROM districts LEFT JOIN sizes ON district = amp_en)""",
)
def _incidents_by_district(t):
    return incidents_by_district(nation_districts(t), incidents(t), "district")


@query(
    "population_by_district",
    f"""WITH {NATION_DISTRICTS}, {POPULATION}
        SELECT amp_th, amp_en, total, male, female,
               {_bins_against("total", "(SELECT max(TOTAL) FROM population)", (0.25, 0.5, 0.75))} AS bin
        FROM (SELECT amp_th, amp_en, coalesce(p.TOTAL, 0) AS total, coalesce(p.MALE, 0) AS male,
                     coalesce(p.FEMALE, 0) AS female
              FROM districts LEFT JOIN population p ON p.DISTRICT = amp_en)""",
)
def _population_by_district(t):
    """Every district is listed twice; the later row, with the true figures, counts."""
    rows = population(t)
    earlier = rows.withColumns({c: F.floor(F.col(c) / 2).cast("bigint") for c in ("TOTAL", "MALE", "FEMALE")})
    listed = rows.withColumn("place", F.lit(2)).unionByName(earlier.withColumn("place", F.lit(1)))
    return population_by_district(nation_districts(t), listed, ["place"])


@query(
    "issues_by_district",
    f"""WITH {NATION_DISTRICTS}, {INCIDENTS},
          sizes AS (SELECT district, count(*) AS total_issues FROM incidents
                    WHERE district IS NOT NULL GROUP BY district),
          filled AS (SELECT amp_th, amp_en, coalesce(total_issues, 0) AS total_issues
                     FROM districts LEFT JOIN sizes ON district = amp_en),
          shares AS (SELECT *, total_issues::DOUBLE / (SELECT count(*) FROM incidents) * 100
                         AS percentage FROM filled)
        SELECT amp_th, amp_en, total_issues, percentage,
               format('{{:.1f}}%', percentage) AS percentage_text,
               {_bin_sql("total_issues", (0.2, 0.4, 0.6, 0.8))} AS bin
        FROM shares""",
)
def _issues_by_district(t):
    return issues_by_district(nation_districts(t), incidents(t), "district", "amp_en")


@query(
    "classification_by_district",
    f"""WITH {LABELED_DOCUMENTS},
          counted AS (SELECT lang, {LABEL_COUNTS}, count(*) AS total, {SEVERITY} AS severity_score
                      FROM complaints WHERE llm_label IS NOT NULL GROUP BY lang),
          districts AS (SELECT source AS amp_en, arg_min(lang, doc_id) AS amp_th
                        FROM documents GROUP BY source),
          filled AS (SELECT amp_th, amp_en, coalesce(sufficient, 0) AS sufficient,
                            coalesce(not_sufficient, 0) AS not_sufficient,
                            coalesce(uncertain, 0) AS uncertain,
                            coalesce(api_error, 0) AS api_error, coalesce(total, 0) AS total,
                            coalesce(severity_score, 0) AS severity_score
                     FROM districts LEFT JOIN counted ON lang = amp_th)
        SELECT *, {_bins_against("severity_score", "(SELECT max(severity_score) FROM counted)",
                                 (0.2, 0.4, 0.6, 0.8))} AS bin FROM filled""",
)
def _classification_by_district(t):
    districts = t.documents.groupBy(F.col("source").alias("amp_en")).agg(
        F.min_by("lang", "doc_id").alias("amp_th")
    )
    return classification_by_district(districts, labeled_documents(t), "lang")
