"""Readers and writers over whole tables: written to a fresh folder and read again."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicloom.operators.filters import filter_time_range
from civicloom.plans.labelling import label_range, labeled_state, read_labeled, read_state, write_labels
from civicloom.plans.loading import load_complaints, verify_load
from civicloom.queries.annotation import rule
from civicloom.queries.registry import LABELED_DOCUMENTS, labeled_documents, query
from civicloom.queries.scalars import clean_sql
from civicloom.session import fresh_path, spread, tasks_for
from civicloom.sources.html import extract_contacts, extract_html_rows, extract_html_tables
from civicloom.sources.nested import read_api_envelope, read_feature_collection, rejected_bodies
from civicloom.sources.snapshots import (
    export_range_csv,
    list_snapshots,
    load_labeled,
    read_snapshot,
    write_snapshot,
)
from civicloom.sources.tables import (
    ReferenceTables,
    count_bad_records,
    read_complaints,
    read_complaints_csv,
    read_enriched_or_raw,
    read_reference_csv,
    reference_tables,
)


def write_csv(df, path: str) -> str:
    """CSV as the complaint export has it: every text quoted, quotes doubled."""
    df.write.csv(
        path,
        header=True,
        quoteAll=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


@query("read_complaints_csv", "SELECT doc_id, text, source, lang FROM documents")
def _read_complaints_csv(t):
    rows = t.documents.select("doc_id", "text", "source", "lang")
    path = write_csv(rows, fresh_path(t.spark, "csv"))
    return read_complaints_csv(t.spark, path, rows.schema)


@query("read_complaints_csv_split", "SELECT doc_id, text, source, lang FROM documents")
def _read_complaints_csv_split(t):
    """The same file cut into as many tasks as its bytes ask for, line breaks in texts or not."""
    rows = t.documents.select("doc_id", "text", "source", "lang")
    path = write_csv(rows, fresh_path(t.spark, "csv"))
    return read_complaints_csv(t.spark, path, rows.schema, split=True)


@query(
    "read_csv_by_name",
    """SELECT doc_id, text, source, lang, CAST(n_chars AS VARCHAR) AS extra,
              (SELECT count(*) FROM documents) AS records, CAST(0 AS BIGINT) AS bad FROM documents""",
)
def _read_csv_by_name(t):
    """Columns in another order than declared, and one in the middle that nobody declared."""
    rows = t.documents.select("doc_id", "text", "source", "lang")
    stored = t.documents.select("lang", "text", F.col("n_chars").alias("extra"), "source", "doc_id")
    path = write_csv(stored, fresh_path(t.spark, "csv"))
    read = read_complaints_csv(t.spark, path, rows.schema, "bad_record")
    records, bad = count_bad_records(read, "bad_record").first()
    return read.drop("bad_record").withColumns({"records": F.lit(records).cast("bigint"), "bad": F.lit(bad).cast("bigint")})


CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string"


def _customers(t):
    return t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


@query("read_reference_csv", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def _read_reference_csv(t):
    padded = _customers(t).toDF(" c_custkey", "c_name ", " c_nationkey ", "c_mktsegment")
    path = write_csv(padded, fresh_path(t.spark, "csv"))
    return read_reference_csv(t.spark, path, padded.schema)


@query(
    "read_enriched_or_raw",
    """SELECT c_custkey, c_name, NULL::DOUBLE AS latitude, NULL::DOUBLE AS longitude, 'raw' AS kind
       FROM customer
       UNION ALL SELECT c_custkey, c_name, c_acctbal, CAST(c_nationkey AS DOUBLE), 'enriched'
       FROM customer""",
)
def _read_enriched_or_raw(t):
    schema = _schema("c_custkey bigint, c_name string")
    raw = write_csv(t.customer.select("c_custkey", "c_name"), fresh_path(t.spark, "raw"))
    located = t.customer.select(
        "c_custkey",
        "c_name",
        F.col("c_acctbal").alias("latitude"),
        F.col("c_nationkey").cast("double").alias("longitude"),
    )
    enriched = write_csv(located, fresh_path(t.spark, "enriched"))
    absent = fresh_path(t.spark, "absent")
    from_raw = read_enriched_or_raw(t.spark, absent, raw, schema)
    from_enriched = read_enriched_or_raw(t.spark, enriched, raw, schema)
    return from_raw.withColumn("kind", F.lit("raw")).unionByName(
        from_enriched.withColumn("kind", F.lit("enriched"))
    )


@query("read_complaints", "SELECT event_id, ts, event_type, props FROM events")
def _read_complaints(t):
    path = fresh_path(t.spark, "complaints")
    t.events.withColumn("ts", F.col("ts").cast("string")).write.parquet(path)
    read = read_complaints(t.spark, path, "ts")
    return read.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", "props")


@query(
    "write_snapshot",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE o_orderstatus END
              AS state FROM orders""",
)
def _write_snapshot(t):
    root = fresh_path(t.spark, "table")
    write_snapshot(t.orders.select("o_orderkey", F.col("o_orderstatus").alias("state")), root)
    changed = F.when(F.col("state") == "P", "pending").otherwise(F.col("state"))
    write_snapshot(read_snapshot(t.spark, root).withColumn("state", changed), root)
    return read_snapshot(t.spark, root)


START, END = datetime(2024, 1, 5), datetime(2024, 1, 12)


def _export(t) -> str:
    folder = fresh_path(t.spark, "shared")
    chosen = filter_time_range(t.events, START, END, "ts")
    return export_range_csv(chosen, folder, START, END)


@query(
    "export_range_csv",
    """SELECT event_id, event_type, value, props, 'labeled_output_01052024_01122024.csv' AS name
       FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'""",
)
def _export_range_csv(t):
    path = _export(t)
    schema = _schema("event_id bigint, ts string, user_id bigint, event_type string, value double, props string")
    return read_complaints_csv(t.spark, path, schema).select(
        "event_id", "event_type", "value", "props", F.lit(path.rsplit("/", 1)[1]).alias("name")
    )


@query(
    "list_snapshots",
    """WITH days AS (SELECT min(CAST(ts AS DATE)) AS first, max(CAST(ts AS DATE)) AS last FROM events),
            ranges AS (SELECT 4 AS place, first AS a, last AS b, '' AS version FROM days
                       UNION ALL SELECT 3, first, first + 6, '' FROM days
                       UNION ALL SELECT 2, last - 3, last, '' FROM days
                       UNION ALL SELECT 1, first, first + 6, '.v2' FROM days)
       SELECT place, 'labeled_output_' || strftime(a, '%m%d%Y') || '_' || strftime(b, '%m%d%Y')
                     || version || '.csv' AS name,
              (SELECT count(*) FROM events WHERE CAST(ts AS DATE) BETWEEN a AND b) AS n
       FROM ranges""",
)
def _list_snapshots(t):
    """Exports of ranges that follow from the data, one of them made twice, listed newest first,
    each with the number of its rows."""
    day = F.col("ts").cast("date")
    first, last = t.events.agg(F.min(day), F.max(day)).first()
    folder = fresh_path(t.spark, "shared")
    for start, end in (
        (first, last),
        (first, first + timedelta(days=6)),
        (last - timedelta(days=3), last),
        (first, first + timedelta(days=6)),
    ):
        export_range_csv(t.events.filter(day.between(start, end)), folder, start, end)
    schema = _schema("event_id bigint")
    counted = [
        read_complaints_csv(t.spark, row["path"], schema).agg(
            F.lit(place).alias("place"), F.lit(row["name"]).alias("name"), F.count("*").alias("n")
        )
        for place, row in enumerate(list_snapshots(t.spark, folder).collect(), 1)
    ]
    return reduce(lambda above, below: above.unionByName(below), counted)


@query(
    "load_labeled",
    f"""WITH {LABELED_DOCUMENTS}
        SELECT doc_id, text, lang AS province, llm_label FROM complaints WHERE lang = 'fr'""",
)
def _load_labeled(t):
    rows = labeled_documents(t).select("doc_id", "text", F.col("lang").alias("province"), "llm_label")
    folder = fresh_path(t.spark, "shared")
    export_range_csv(rows.filter(F.col("lang") == "en"), folder, START, START)
    export_range_csv(rows, folder, START, END)
    return load_labeled(t.spark, rows.schema, folder, province="fr")


@query(
    "read_feature_collection",
    """SELECT s_name AS amp_en, CAST(s_suppkey AS VARCHAR) AS amp_th,
              '{"type":"Point","coordinates":[' || s_nationkey || ',' || s_suppkey || ']}' AS geometry
       FROM supplier""",
)
def _read_feature_collection(t):
    geometry = F.struct(
        F.lit("Point").alias("type"),
        F.array(F.col("s_nationkey").cast("bigint"), "s_suppkey").alias("coordinates"),
    )
    feature = F.struct(
        F.struct(
            F.col("s_name").alias("amp_en"), F.col("s_suppkey").cast("string").alias("amp_th")
        ).alias("properties"),
        geometry.alias("geometry"),
    )
    collection = F.to_json(
        F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features"))
    )
    path = fresh_path(t.spark, "geojson")
    t.supplier.select(collection.alias("value")).write.text(path)
    return read_feature_collection(t.spark, path, multi_line=False)


@query(
    "read_feature_document",
    """SELECT s_name AS amp_en, CAST(s_suppkey AS VARCHAR) AS amp_th, '{"type":"Point"}' AS geometry
       FROM supplier""",
)
def _read_feature_document(t):
    """Whole documents over several lines, one for each nation of the suppliers."""
    feature = F.struct(
        F.struct(F.col("s_name").alias("amp_en"), F.col("s_suppkey").cast("string").alias("amp_th")).alias("properties"),
        F.struct(F.lit("Point").alias("type")).alias("geometry"),
    )
    one = t.supplier.groupBy("s_nationkey").agg(F.collect_list(feature).alias("features"))
    text = F.to_json(F.struct("features"), {"pretty": "true"})
    path = fresh_path(t.spark, "geojson")
    one.select("s_nationkey", text.alias("value")).write.partitionBy("s_nationkey").text(path)
    read = read_feature_collection(t.spark, f"{path}/*")
    return read.withColumn("geometry", F.to_json(F.try_parse_json("geometry")))


@query(
    "read_api_envelope",
    """SELECT event_id, unnest(['value', 'k']) AS field,
              unnest([value, CAST(props::JSON ->> 'k' AS DOUBLE)]) AS amount,
              user_id AS total, CAST(2 AS BIGINT) AS fetched
       FROM events WHERE event_type <> 'error'""",
)
def _read_api_envelope(t):
    def record(field: str, amount):
        return F.struct(
            F.lit("extra").alias("note"), "event_id", F.lit(field).alias("field"), amount.alias("amount")
        )

    record_schema = _schema("event_id bigint, field string, amount double")
    k = F.get_json_object("props", "$.k").cast("double")
    body = F.to_json(
        F.struct(
            (F.col("event_type") != "error").alias("success"),
            F.struct(
                F.col("user_id").alias("total"),
                F.array(record("value", F.col("value")), record("k", k)).alias("records"),
            ).alias("result"),
        )
    )
    return read_api_envelope(t.events.select(body.alias("body")), record_schema)


@query(
    "rejected_bodies",
    """SELECT event_id, CASE event_type WHEN 'error' THEN 'unsuccessful' WHEN 'click' THEN 'unreadable'
                             WHEN 'view' THEN 'no records' ELSE 'incomplete' END AS reason
       FROM events WHERE event_type IN ('error', 'click', 'view') OR value > 1""",
)
def _rejected_bodies(t):
    kind, value = F.col("event_type"), F.col("value")
    record = F.array(F.struct("event_id"))
    result = F.struct(
        F.when(value > 1, F.lit(2)).otherwise(F.lit(1)).alias("total"),
        F.when(kind != "view", record).alias("records"),
    )
    whole = F.to_json(F.struct(F.when(kind == "error", F.lit(False)).alias("success"), result.alias("result")))
    body = F.when(kind == "click", F.concat(F.lit("<html>"), whole)).otherwise(whole)
    return rejected_bodies(
        t.events.select("event_id", body.alias("body")), _schema("event_id bigint")
    ).select("event_id", "reason")


_NAV_ROWS_SQL = """SELECT page_id, CAST(0 AS INTEGER) AS table_idx, CAST(0 AS INTEGER) AS row_idx,
              false AS by_class, replace(replace(replace(CAST(to_json(cells) AS VARCHAR),
                  '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS cells
       FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '<nav>.*?</nav>'),
                                                '<li><a[^>]*>(.*?)</a></li>', 1) AS cells
             FROM pages)
       WHERE len(cells) > 0"""


@query("extract_html_rows", _NAV_ROWS_SQL)
def _extract_html_rows(t):
    rows = extract_html_rows(
        t.pages, row_tag="ul", cell_tags=("li",), table_tag="nav", partitions=tasks_for(t.spark)
    )
    return rows.withColumn("cells", F.to_json("cells"))


@query("extract_html_rows_implied", _NAV_ROWS_SQL)
def _extract_html_rows_implied(t):
    dealt = spread(t.pages.select("page_id", "html"), tasks_for(t.spark))
    pages = dealt.withColumn("html", F.regexp_replace("html", "</(li|ul|a)>", ""))
    rows = extract_html_rows(pages, row_tag="ul", cell_tags=("li",), table_tag="nav", implied_ends=True)
    return rows.withColumn("cells", F.to_json("cells"))


def _dealt_customers(t):
    """Customers dealt out to all cores before pages are made of them: their file is small and has
    few row groups, and a task that reads a page takes thousands of times what it takes to move a
    customer."""
    columns = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return spread(t.customer.select(*columns), tasks_for(t.spark))


def _cells(tag: str, *values) -> F.Column:
    parts = [F.concat(F.lit(f"<{tag}> "), value, F.lit(f"\n</{tag}>")) for value in values]
    return F.concat(F.lit("<tr>"), *parts, F.lit("</tr>"))


@query(
    "extract_contacts",
    """SELECT c_custkey AS page_id, 0 AS table_idx, 1 AS row_idx, c_name AS name,
              CAST(c_nationkey AS VARCHAR) AS phone, c_mktsegment AS fax FROM customer
       UNION ALL SELECT c_custkey, 0, 3, c_mktsegment, c_name, CAST(c_nationkey AS VARCHAR)
       FROM customer""",
)
def _extract_contacts(t):
    name, phone, fax = F.col("c_name"), F.col("c_nationkey").cast("string"), F.col("c_mktsegment")
    page = F.concat(
        F.lit("<p>x</p><table class='wide mark'>"),
        _cells("th", F.lit("ชื่อ"), F.lit("หมายเลขโทรศัพท์"), F.lit("Fax")),
        _cells("td", name, phone, fax),
        _cells("td", F.lit("โทรสาร"), F.lit("ชื่อ"), F.lit("โทรศัพท์")),
        _cells("td", phone, fax, name),
        F.lit("</table><table><tr><td>other</td><td>1</td></tr></table>"),
    )
    pages = _dealt_customers(t).select(F.col("c_custkey").alias("page_id"), page.alias("html"))
    return extract_contacts(extract_html_tables(pages, table_class="mark"), "stations")


@query(
    "extract_hospital_contacts",
    """SELECT c_custkey AS page_id, 0 AS table_idx, 2 AS row_idx, c_name AS name_th,
              c_mktsegment || ' Hospital' AS name_en, CAST(c_nationkey AS VARCHAR) AS phone
       FROM customer""",
)
def _extract_hospital_contacts(t):
    name, phone = F.col("c_name"), F.col("c_nationkey").cast("string")
    english = F.concat("c_mktsegment", F.lit(" Hospital"))
    page = F.concat(
        F.lit("<table>"),
        _cells("td", F.lit("1"), F.lit("before"), F.lit("any"), F.lit("heading")),
        _cells(
            "th", F.lit("ลำดับ"), F.lit("ชื่อสถานพยาบาล"), F.lit("List of Network Hospital"), F.lit("Telephone")
        ),
        _cells("td", F.lit("1"), name, english, phone),
        _cells("td", F.lit("2"), phone, english, phone),
        _cells("td", F.lit("3"), F.lit("---"), english, phone),
        F.lit("</table>"),
    )
    pages = _dealt_customers(t).select(F.col("c_custkey").alias("page_id"), page.alias("html"))
    return extract_contacts(extract_html_tables(pages), "hospitals")


@query(
    "dataset",
    """SELECT 'hospitals' AS dataset, count(*) AS n FROM customer
       UNION ALL SELECT 'fire_stations', count(*) FROM supplier
       UNION ALL SELECT 'fire_incidents', count(*) FROM orders WHERE o_orderkey <> 1
       UNION ALL SELECT 'population', count(DISTINCT c_nationkey) FROM customer""",
)
def _dataset(t):
    def csv(df):
        return write_csv(df, fresh_path(t.spark, "csv")), df.schema

    hospitals = csv(t.customer.select("c_custkey", "c_name"))
    stations = csv(t.supplier.select("s_suppkey", "s_name"))
    incidents = csv(t.orders.select(F.col("o_orderkey").alias("_id"), F.col("o_orderstatus").alias("District")))
    population = csv(t.customer.groupBy("c_nationkey").agg(F.count("*").alias("TOTAL")))
    absent = fresh_path(t.spark, "absent")
    tables: ReferenceTables = reference_tables(
        t.spark,
        hospitals=(absent, *hospitals),
        fire_stations=(absent, *stations),
        fire_incidents=incidents,
        population=population,
    )
    tables.all()
    return t.spark.sql(
        """SELECT 'hospitals' AS dataset, count(*) AS n FROM hospitals
           UNION ALL SELECT 'fire_stations', count(*) FROM fire_stations
           UNION ALL SELECT 'fire_incidents', count(*) FROM fire_incidents
           UNION ALL SELECT 'population', count(*) FROM population"""
    )


@query(
    "load_complaints",
    f"SELECT doc_id, {clean_sql('text')} AS comment, o_orderdate AS timestamp "
    "FROM documents LEFT JOIN orders ON o_orderkey = doc_id",
)
def _load_complaints(t):
    return _loaded(t).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _loaded(t):
    rows = t.documents.join(t.orders, F.col("o_orderkey") == F.col("doc_id"), "left").select(
        "doc_id",
        F.col("text").alias("comment"),
        F.col("o_orderdate").cast("string").alias("timestamp"),
    )
    path = write_csv(rows, fresh_path(t.spark, "csv"))
    return load_complaints(t.spark, path, fresh_path(t.spark, "table"), rows.schema)


@query(
    "verify_load",
    """SELECT count(*) AS row_count, count(*) - count(doc_id) AS doc_id,
              count(*) - count(text) AS comment, count(*) - count(o_orderdate) AS timestamp
       FROM documents LEFT JOIN orders ON o_orderkey = doc_id""",
)
def _verify_load(t):
    return verify_load(_loaded(t))


@query(
    "label_range",
    f"""WITH {LABELED_DOCUMENTS},
          timed AS (SELECT doc_id, text, source, lang, quality, llm_label, 'earlier ' || code AS llm_reasoning, ts
                    FROM complaints JOIN events ON event_id = doc_id),
          pending AS (SELECT *, row_number() OVER (ORDER BY ts, doc_id) AS rn FROM timed
                      WHERE ts BETWEEN TIMESTAMP '2024-01-01 06:00:00' AND TIMESTAMP '2024-01-03'
                        AND (llm_label IS NULL OR llm_label = 'API Error')),
          batched AS (SELECT *, (rn - 1) // 20 AS batch, (rn - 1) % 20 AS pos FROM pending),
          kinds AS (SELECT batch, arg_min(lang, pos) AS kind FROM batched GROUP BY batch),
          new AS (SELECT doc_id,
               CASE WHEN kind = 'fr' THEN 'API Error'
                    WHEN kind = 'de' OR lang = 'de' THEN 'Missing in JSON Response'
                    WHEN lang = 'es' THEN 'Invalid Label from LLM'
                    WHEN quality = 0 THEN 'Not Sufficient'
                    ELSE 'Uncertain (has partial evidence)' END AS new_label,
               CASE WHEN kind = 'fr' THEN 'API error: busy'
                    WHEN kind = 'de' THEN 'Failed to parse JSON response'
                    WHEN lang = 'de' THEN 'Missing result in JSON response'
                    WHEN lang = 'es' THEN 'Invalid label returned by LLM'
                    ELSE source END AS new_reasoning
               FROM batched JOIN kinds USING (batch))
        SELECT t.doc_id, ts, coalesce(new_label, llm_label) AS llm_label,
               coalesce(new_reasoning, llm_reasoning) AS llm_reasoning
        FROM timed t LEFT JOIN new ON new.doc_id = t.doc_id""",
)
def _label_range(t):
    rows = (
        labeled_documents(t)
        .join(t.events, F.col("event_id") == F.col("doc_id"))
        .select(
            F.col("doc_id"),
            F.col("text").alias("comment"),
            F.col("source").alias("type"),
            F.col("lang").alias("organization"),
            F.col("quality").alias("star"),
            "llm_label",
            F.concat(F.lit("earlier "), "code").alias("llm_reasoning"),
            "ts",
        )
    )
    root = fresh_path(t.spark, "table")
    write_snapshot(rows, root)
    start, end = datetime(2024, 1, 1, 6), datetime(2024, 1, 3)
    table = label_range(t.spark, root, rule, start, end, ["ts", "doc_id"], "doc_id", "ts")
    return table.select("doc_id", "ts", "llm_label", "llm_reasoning")


def _run_of(rows, label: str):
    return rows.select(
        F.col("doc_id").cast("string").alias("ticket_id"), F.lit(label).alias("llm_label"),
        F.col("source").alias("llm_reasoning"), F.lit(1).cast("bigint").alias("batch_num"), F.lit(1).alias("pos"))


@query(
    "fold_with_two_writers",
    """SELECT doc_id, lang, CASE WHEN doc_id % 3 = 0 OR lang = 'fr' THEN 'Not Sufficient'
                                 WHEN lang = 'en' THEN 'Sufficient' END AS llm_label,
              CASE WHEN doc_id % 3 = 0 OR lang IN ('en', 'fr') THEN source END AS llm_reasoning
       FROM documents""",
)
def _fold_with_two_writers(t):
    """One writer folds labels into the table; two runs of another end after the fold has read
    and before it is written. No label is lost, and the later one of a row counts."""
    root = fresh_path(t.spark, "table")
    docs = t.documents.select("doc_id", "source", "lang")
    write_snapshot(docs.select("doc_id", "lang"), root)
    write_labels(_run_of(docs.where("lang = 'en'"), "Sufficient"), root)
    state = labeled_state(t.spark, root)
    folded = read_state(t.spark, root, state, "doc_id")
    write_labels(_run_of(docs.where("doc_id % 3 = 0"), "Not Sufficient"), root)
    write_labels(_run_of(docs.where("lang = 'fr'"), "Not Sufficient"), root)
    write_snapshot(folded, root, holds=state.runs, base=state.manifest)
    return read_labeled(t.spark, root, "doc_id").select("doc_id", "lang", "llm_label", "llm_reasoning")


@query(
    "read_labeled_by_day",
    """SELECT event_id, CAST(ts AS DATE)::VARCHAR AS day,
              CASE WHEN CAST(ts AS DATE) = DATE '2024-01-02' AND event_type = 'click' THEN 'Sufficient' END AS llm_label
       FROM events""",
)
def _read_labeled_by_day(t):
    """Labels of one day: only that day's folder is joined with them."""
    root = fresh_path(t.spark, "table")
    rows = t.events.select("event_id", "event_type", F.to_date("ts").alias("day"))
    write_snapshot(rows.select("event_id", "day"), root, ("day",))
    chosen = rows.where((F.col("day") == F.lit("2024-01-02").cast("date")) & (F.col("event_type") == "click"))
    run = chosen.select(F.col("event_id").alias("doc_id"), F.lit("r").alias("source"))
    write_labels(_run_of(run, "Sufficient"), root, ["2024-01-02"])
    return read_labeled(t.spark, root, "event_id", "day").select(
        "event_id", F.col("day").cast("string").alias("day"), "llm_label")
