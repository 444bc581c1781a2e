"""Label merges, district look-ups and coordinates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicloom.operators.aggregate import group_sizes
from civicloom.operators.filters import split_by_status
from civicloom.operators.join import (
    attach_feature_stats,
    district_two_key_lookup,
    district_zero_fill,
    enrich_coordinates,
    merge_labels_replace,
    merge_labels_upsert,
    translate_names,
    union_cached_and_new,
)
from civicloom.queries.aggregates import INCIDENTS, incidents
from civicloom.queries.registry import (
    LABELED_DOCUMENTS,
    NATION_DISTRICTS,
    labeled_documents,
    nation_districts,
    query,
)


def labeled_table(t):
    """Documents with earlier labels; one source has no ids."""
    return labeled_documents(t).select(
        F.when(F.col("source") != "src0", F.col("doc_id").cast("string")).alias("ticket_id"),
        "source",
        "lang",
        "llm_label",
        F.concat(F.lit("earlier "), "code").alias("llm_reasoning"),
    )


LABELED_TABLE = f"""{LABELED_DOCUMENTS},
    labeled_table AS (SELECT CASE WHEN source <> 'src0' THEN CAST(doc_id AS VARCHAR) END AS ticket_id, source, lang,
                             llm_label, 'earlier ' || code AS llm_reasoning FROM complaints)
"""


def new_labels(t):
    """New labels: one for every English document, a second, later one for those in ``labels``."""
    first = t.documents.filter(F.col("lang") == "en").select(
        F.col("doc_id").cast("string").alias("ticket_id"),
        F.lit("Sufficient").alias("llm_label"),
        F.lit("first").alias("llm_reasoning"),
        F.lit(1).alias("run"),
    )
    second = first.join(t.labels, F.col("ticket_id") == F.col("doc_id").cast("string")).select(
        "ticket_id",
        F.when(F.col("toxic") == 1, "API Error").otherwise("Not Sufficient").alias("llm_label"),
        F.lit("second").alias("llm_reasoning"),
        F.lit(2).alias("run"),
    )
    return first.unionByName(second)


NEW_LABELS = """
    first_labels AS (SELECT CAST(doc_id AS VARCHAR) AS ticket_id, 'Sufficient' AS llm_label,
                            'first' AS llm_reasoning, 1 AS run
                     FROM documents WHERE lang = 'en'),
    new_labels AS (SELECT * FROM first_labels UNION ALL
                   SELECT ticket_id, CASE WHEN toxic = 1 THEN 'API Error' ELSE 'Not Sufficient' END,
                          'second', 2 FROM first_labels JOIN labels ON CAST(doc_id AS VARCHAR) = ticket_id)
"""


@query(
    "merge_labels_replace",
    f"""WITH {LABELED_TABLE}, {NEW_LABELS}
        SELECT t.ticket_id, source, lang, n.llm_label, n.llm_reasoning
        FROM labeled_table t LEFT JOIN new_labels n ON n.ticket_id = t.ticket_id""",
)
def _merge_labels_replace(t):
    return merge_labels_replace(labeled_table(t), new_labels(t))


@query(
    "merge_labels_upsert",
    f"""WITH {LABELED_TABLE}, {NEW_LABELS},
          latest AS (SELECT ticket_id, arg_max(llm_label, run) AS new_label,
                            arg_max(llm_reasoning, run) AS new_reasoning
                     FROM new_labels GROUP BY ticket_id)
        SELECT t.ticket_id, source, lang, coalesce(new_label, llm_label) AS llm_label,
               coalesce(new_reasoning, llm_reasoning) AS llm_reasoning
        FROM labeled_table t LEFT JOIN latest n ON n.ticket_id = t.ticket_id""",
)
def _merge_labels_upsert(t):
    return merge_labels_upsert(labeled_table(t), new_labels(t), ["run"])


@query(
    "district_zero_fill",
    f"""WITH {NATION_DISTRICTS},
          more AS (SELECT amp_th, amp_en FROM districts UNION ALL SELECT r_name, r_name FROM region)
        SELECT amp_th, amp_en, count(s_suppkey) AS incidents FROM more
        LEFT JOIN supplier ON 'NATION_' || s_nationkey = amp_en GROUP BY amp_th, amp_en""",
)
def _district_zero_fill(t):
    """All suppliers as incidents; the regions, listed as districts too, have none."""
    rows = t.supplier.select(F.concat(F.lit("NATION_"), "s_nationkey").alias("name"))
    regions = t.region.select(F.col("r_name").alias("amp_th"), F.col("r_name").alias("amp_en"))
    sizes = group_sizes(rows, "name", "incidents")
    return district_zero_fill(
        nation_districts(t).unionByName(regions), sizes, "amp_en", "name", ["incidents"]
    )


def two_key_stats(t):
    """Orders of a nation under its English name, and open orders under its Thai one. Nations
    of one region have no English name, those of another have a 0 there."""
    named = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    )
    in_english = (
        named.filter(F.col("r_name") != "EUROPE")
        .groupBy(F.col("n_name").alias("name"))
        .agg(F.count_if(F.col("r_name") != "AFRICA").alias("n"))
    )
    in_thai = (
        named.filter(F.col("o_orderstatus") == "O")
        .groupBy(F.col("n_nationkey").cast("string").alias("name"))
        .agg(F.count("*").alias("n"))
    )
    return in_english.unionByName(in_thai)


TWO_KEY_STATS = """
    named AS (SELECT n_nationkey, n_name, r_name, o_orderstatus
              FROM orders JOIN customer ON c_custkey = o_custkey
              JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
    by_en AS (SELECT n_name AS name, count(*) FILTER (r_name <> 'AFRICA') AS n
              FROM named WHERE r_name <> 'EUROPE' GROUP BY n_name),
    by_th AS (SELECT CAST(n_nationkey AS VARCHAR) AS name, count(*) AS n
              FROM named WHERE o_orderstatus = 'O' GROUP BY n_nationkey)
"""


@query(
    "district_two_key_lookup",
    f"""WITH {NATION_DISTRICTS}, {TWO_KEY_STATS}
        SELECT amp_th, amp_en,
               CASE WHEN by_en.name IS NOT NULL THEN by_en.n ELSE coalesce(by_th.n, 0) END AS n
        FROM districts LEFT JOIN by_en ON by_en.name = amp_en LEFT JOIN by_th ON by_th.name = amp_th""",
)
def _district_two_key_lookup(t):
    return district_two_key_lookup(nation_districts(t), two_key_stats(t), "name", ["n"])


@query(
    "district_two_key_lookup_zero",
    f"""WITH {NATION_DISTRICTS}, {TWO_KEY_STATS}
        SELECT amp_th, amp_en, coalesce(nullif(by_en.n, 0), by_th.n, 0) AS n
        FROM districts LEFT JOIN by_en ON by_en.name = amp_en LEFT JOIN by_th ON by_th.name = amp_th""",
)
def _district_two_key_lookup_zero(t):
    return district_two_key_lookup(
        nation_districts(t), two_key_stats(t), "name", ["n"], zero_falls_through=True
    )


@query(
    "translate_names",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'nowhere'
                              ELSE CAST(c_nationkey AS VARCHAR) END AS district,
              CASE WHEN c_acctbal < 0 THEN 'nowhere' ELSE n_name END AS district_en
       FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def _translate_names(t):
    rows = t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, "nowhere")
        .otherwise(F.col("c_nationkey").cast("string"))
        .alias("district"),
    )
    return translate_names(rows, nation_districts(t), "district")


@query(
    "enrich_coordinates",
    """SELECT c_custkey, name,
              CASE WHEN kept THEN latitude ELSE coalesce(lat, latitude) END AS latitude,
              CASE WHEN kept THEN longitude ELSE coalesce(lon, longitude) END AS longitude
       FROM (SELECT *, latitude IS NOT NULL AND longitude IS NOT NULL AS kept FROM
              (SELECT c_custkey,
                      CASE WHEN c_mktsegment = 'BUILDING' THEN ' ' ELSE 'NATION_' || c_nationkey END
                          AS name,
                      CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS latitude,
                      CASE WHEN c_mktsegment <> 'MACHINERY' THEN 100.5::DOUBLE END AS longitude
               FROM customer))
       LEFT JOIN (SELECT n_name, n_nationkey + 0.25::DOUBLE AS lat, n_regionkey + 0.5::DOUBLE AS lon
                  FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name <> 'ASIA')
         ON n_name = name""",
)
def _enrich_coordinates(t):
    rows = t.customer.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", " ")
        .otherwise(F.concat(F.lit("NATION_"), "c_nationkey"))
        .alias("name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("latitude"),
        F.when(F.col("c_mktsegment") != "MACHINERY", 100.5).alias("longitude"),
    )
    return enrich_coordinates(rows, nation_gazetteer(t), "name")


def nation_gazetteer(t):
    """Nations with coordinates, but for one region."""
    placed = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    return placed.filter(F.col("r_name") != "ASIA").select(
        F.col("n_name").alias("name"),
        (F.col("n_nationkey") + F.lit(0.25)).cast("double").alias("latitude"),
        (F.col("n_regionkey") + F.lit(0.5)).cast("double").alias("longitude"),
    )


@query(
    "attach_feature_stats",
    f"""WITH {NATION_DISTRICTS}, {INCIDENTS}
        SELECT amp_th, amp_en, 'Feature' AS type, count(o_orderkey) AS incidents,
               'Point' AS shape FROM districts LEFT JOIN incidents ON district = amp_en
        GROUP BY amp_th, amp_en""",
)
def _attach_feature_stats(t):
    point = F.to_json(
        F.struct(F.lit("Point").alias("type"), F.array(F.col("amp_th").cast("int"), F.lit(13)).alias("coordinates"))
    )
    features = nation_districts(t).withColumn("geometry", point)
    sizes = group_sizes(incidents(t), "district", "incidents")
    filled = district_zero_fill(features, sizes, "amp_en", "district", ["incidents"])
    built = attach_feature_stats(filled, ["incidents"])
    return built.select(
        F.get_json_object("feature", "$.properties.amp_th").alias("amp_th"),
        F.get_json_object("feature", "$.properties.amp_en").alias("amp_en"),
        F.get_json_object("feature", "$.type").alias("type"),
        F.get_json_object("feature", "$.properties.incidents").cast("bigint").alias("incidents"),
        F.get_json_object("feature", "$.geometry.type").alias("shape"),
    )


@query(
    "union_cached_and_new",
    f"""WITH {LABELED_DOCUMENTS}
        SELECT doc_id, llm_label, CAST(NULL AS VARCHAR) AS status FROM complaints
        WHERE llm_label IS NOT NULL AND llm_label <> 'API Error'
        UNION ALL SELECT doc_id, 'Sufficient', CASE WHEN llm_label IS NULL THEN 'new' ELSE 'retry' END
        FROM complaints WHERE llm_label IS NULL OR llm_label = 'API Error'""",
)
def _union_cached_and_new(t):
    rows = split_by_status(labeled_documents(t).select("doc_id", "llm_label"))
    cached = rows.filter(F.col("status") == "cached").drop("status")
    new = rows.filter(F.col("status") != "cached").withColumn("llm_label", F.lit("Sufficient"))
    return union_cached_and_new(cached, new)
