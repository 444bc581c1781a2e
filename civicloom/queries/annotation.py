"""Requests, answers and look-ups, with a rule in place of a model."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from civicloom.operators.annotate import (
    annotate,
    build_requests,
    label_rows,
    lookup,
    match_answers,
    parse_answers,
    pending_rows,
)
from civicloom.operators.numbering import assign_batches
from civicloom.queries.joins import nation_gazetteer
from civicloom.queries.registry import LABELED_DOCUMENTS, labeled_documents, query
from civicloom.session import fresh_path

ROLES = {"type": "source", "organization": "lang", "comment": "text", "star": "quality"}


def batched_documents(t, *columns: str):
    return assign_batches(labeled_documents(t).select("doc_id", *columns), ["doc_id"])


BATCHED = f"""{LABELED_DOCUMENTS},
    numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn FROM complaints),
    batched AS (SELECT *, CAST((rn - 1) // 20 + 1 AS BIGINT) AS batch_num,
                       CAST((rn - 1) % 20 + 1 AS INTEGER) AS pos FROM numbered),
    batch_kind AS (SELECT batch_num, arg_min(lang, pos) AS kind FROM batched GROUP BY batch_num)
"""


@query(
    "build_request_text",
    f"""WITH {BATCHED}
        SELECT batch_num, string_agg(
          '--- เรื่องร้องเรียนที่ ' || pos || ' (Ticket ID: ' || doc_id || ') ---' || chr(10)
          || 'ประเภทปัญหา: ' || source || chr(10) || 'หน่วยงานรับผิดชอบ: ' || lang || chr(10)
          || 'รายละเอียด: ' || text || chr(10)
          || 'ข้อมูล Outcome: สถานะ: , มีรูปหลังแก้ไข: ไม่'
          || CASE WHEN quality IS NOT NULL
                  THEN ', คะแนนความพึงพอใจ: ' || CAST(quality AS DOUBLE) || '/5' ELSE '' END
          || chr(10) || chr(10), '' ORDER BY pos) AS request
        FROM batched GROUP BY batch_num""",
)
def _build_request_text(t):
    return build_requests(batched_documents(t, *ROLES.values()), "doc_id", ROLES).select("batch_num", "request")


def answered_batches(t):
    """Answers written from the labels: documents without a label are left out, good ones have
    the label 1, poor ones the text 0, those marked toxic a label nobody knows. The language of
    the batch's first document decides how the answer comes: in a json fence, in a bare fence,
    cut off, or plain with a repeated entry for its first document."""
    entry = F.to_json(
        F.when(F.col("code") == "1", F.struct(F.col("doc_id").alias("id"), F.lit(1).alias("label"),
                                              F.col("source").alias("reasoning")))
    )
    poor = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.lit("0").alias("label"),
                              F.col("source").alias("reasoning")))
    odd = F.to_json(F.struct(F.col("doc_id").alias("id"), F.lit(7).alias("label")))
    item = F.when(F.col("code") == "1", entry).when(F.col("code") == "0", poor).when(
        F.col("code").isNotNull(), odd
    )
    batches = (
        batched_documents(t, "source", "lang", "code")
        .select(
            "batch_num",
            F.struct(
                "pos", F.col("doc_id").cast("string").alias("ticket_id"), "lang", item.alias("item")
            ).alias("row"),
        )
        .groupBy("batch_num")
        .agg(F.sort_array(F.collect_list("row")).alias("rows"))
    )
    items = F.filter(F.col("rows.item"), lambda text: text.isNotNull())
    first = F.col("rows")[0]
    body = F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    again = F.to_json(
        F.array(
            F.struct(first["ticket_id"].alias("id"), F.lit(2).alias("label"), F.lit("again").alias("reasoning"))
        )
    )
    repeated = F.when(F.size(items) == 0, again).otherwise(
        F.concat(F.rtrim(body, F.lit("]")), F.lit(","), F.ltrim(again, F.lit("[")))
    )
    kind = first["lang"]
    return batches.select(
        "batch_num",
        F.transform("rows", lambda r: F.struct(r["pos"], r["ticket_id"])).alias("members"),
        F.when(kind == "en", F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```\n")))
        .when(kind == "fr", F.concat(F.lit("```\n"), body, F.lit("\n```")))
        .when(kind == "de", F.concat(body, F.lit(" and so on")))
        .otherwise(repeated)
        .alias("answer"),
    )


ANSWERED = f"""{BATCHED},
    expected AS (SELECT batch_num, pos, CAST(doc_id AS VARCHAR) AS id, kind,
        CASE WHEN kind = 'es' AND pos = 1 THEN '2' WHEN code IN ('0', '1') THEN code
             WHEN code IS NOT NULL THEN '254' END AS code,
        CASE WHEN kind = 'es' AND pos = 1 THEN 'again' WHEN code IN ('0', '1') THEN source
             WHEN code IS NOT NULL THEN 'Invalid label returned by LLM' END AS reasoning
      FROM batched JOIN batch_kind USING (batch_num))
"""


@query(
    "parse_answers",
    f"""WITH {ANSWERED} SELECT batch_num, id, code, reasoning FROM expected
        WHERE kind <> 'de' AND code IS NOT NULL""",
)
def _parse_answers(t):
    return parse_answers(answered_batches(t))


@query(
    "match_answers",
    f"""WITH {ANSWERED} SELECT batch_num, pos, id AS ticket_id,
          CASE WHEN kind = 'de' THEN '253' ELSE coalesce(code, '253') END AS code,
          CASE WHEN kind = 'de' THEN 'Failed to parse JSON response'
               ELSE coalesce(reasoning, 'Missing result in JSON response') END AS reasoning
        FROM expected""",
)
def _match_answers(t):
    return match_answers(answered_batches(t))


def rule(request: str) -> str:
    """Stands in for a model: reads the request's lines and labels by the rating."""
    sections = re.findall(
        r"^--- \S+ \d+ \(Ticket ID: (\S+)\) ---\nประเภทปัญหา: (\S+)\nหน่วยงานรับผิดชอบ: (\S+)\n"
        r"(.*?)^ข้อมูล Outcome: (.*?)$",
        request,
        re.MULTILINE | re.DOTALL,
    )
    kind = sections[0][2]
    if kind == "fr":
        raise RuntimeError("busy")
    if kind == "de":
        return "I cannot say."
    items = []
    for ticket_id, source, lang, _, outcome in sections:
        if lang == "de":
            continue
        label = 9 if lang == "es" else 0 if "0.0/5" in outcome else "2"
        items.append({"id": ticket_id, "label": label, "reasoning": source})
    text = json.dumps(items)
    return f"```json\n{text}\n```" if kind == "en" else text


@query(
    "annotate",
    f"""WITH {LABELED_DOCUMENTS},
          pending AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn FROM complaints
                      WHERE llm_label IS NULL OR llm_label = 'API Error'),
          batched AS (SELECT *, CAST((rn - 1) // 20 + 1 AS BIGINT) AS batch_num,
                             CAST((rn - 1) % 20 + 1 AS INTEGER) AS pos FROM pending),
          batch_kind AS (SELECT batch_num, arg_min(lang, pos) AS kind FROM batched GROUP BY batch_num)
        SELECT CAST(doc_id AS VARCHAR) AS ticket_id, llm_label, 'earlier ' || code AS llm_reasoning,
               CAST(0 AS BIGINT) AS batch_num, CAST(0 AS INTEGER) AS pos FROM complaints
        WHERE llm_label IS NOT NULL AND llm_label <> 'API Error'
        UNION ALL
        SELECT CAST(doc_id AS VARCHAR),
               CASE WHEN kind = 'fr' THEN 'API Error' WHEN kind = 'de' THEN 'Missing in JSON Response'
                    WHEN lang = 'de' THEN 'Missing in JSON Response'
                    WHEN lang = 'es' THEN 'Invalid Label from LLM'
                    WHEN quality = 0 THEN 'Not Sufficient'
                    ELSE 'Uncertain (has partial evidence)' END,
               CASE WHEN kind = 'fr' THEN 'API error: busy'
                    WHEN kind = 'de' THEN 'Failed to parse JSON response'
                    WHEN lang = 'de' THEN 'Missing result in JSON response'
                    WHEN lang = 'es' THEN 'Invalid label returned by LLM'
                    ELSE source END, batch_num, pos
        FROM batched JOIN batch_kind USING (batch_num)""",
)
def _annotate(t):
    rows = labeled_documents(t).withColumn("llm_reasoning", F.concat(F.lit("earlier "), "code"))
    return annotate(rows, rule, ["doc_id"], "doc_id", ROLES)


def _asked(request: str) -> list[str]:
    return re.findall(r"\(Ticket ID: (\S+)\)", request)


def first_rule(request: str) -> str:
    """Stands in for a model that is down whenever it is asked about a document of number 7, 17, ..."""
    ids = _asked(request)
    if any(i.endswith("7") for i in ids):
        raise RuntimeError("down")
    return json.dumps([{"id": i, "label": 1, "reasoning": "first"} for i in ids])


def second_rule(request: str) -> str:
    return json.dumps([{"id": i, "label": 0, "reasoning": "second"} for i in _asked(request)])


@query(
    "annotate_resumed",
    """WITH numbered AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM documents),
          earlier AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 5 AS batch FROM documents WHERE lang = 'en'),
          down AS (SELECT DISTINCT batch FROM earlier WHERE doc_id % 10 = 7)
       SELECT CAST(n.doc_id AS VARCHAR) AS ticket_id,
              CASE WHEN e.batch IS NOT NULL AND d.batch IS NULL THEN 'Sufficient' ELSE 'Not Sufficient' END AS llm_label,
              CASE WHEN e.batch IS NOT NULL AND d.batch IS NULL THEN 'first' ELSE 'second' END AS llm_reasoning,
              CAST(rn // 5 + 1 AS BIGINT) AS batch_num, CAST(rn % 5 + 1 AS INTEGER) AS pos
       FROM numbered n LEFT JOIN earlier e ON e.doc_id = n.doc_id LEFT JOIN down d ON d.batch = e.batch""",
)
def _annotate_resumed(t):
    """A run over a part of the documents, some of whose calls fail; then a run over all: what the
    first one was told is not asked again, whatever batch it stands in now."""
    rows = t.documents.select("doc_id", F.col("text").alias("comment"), "lang")
    journal, options = fresh_path(t.spark, "journal"), {"order_by": ["doc_id"], "id_col": "doc_id", "batch_size": 5}
    label_rows(rows.where("lang = 'en'").drop("lang"), first_rule, journal=journal, journal_every=64, **options)
    return label_rows(rows.drop("lang"), second_rule, journal=journal, journal_every=64, **options).drop("code")


def locate(name: str):
    """Stands in for a geocoder: knows the nations whose number ends in 2 to 9."""
    number = int(name.rsplit("_", 1)[1])
    if name.endswith("0"):
        raise TimeoutError(name)
    return None if name.endswith("1") else (number + 0.75, 99.0)


@query(
    "lookup",
    """SELECT c_custkey, name, CASE WHEN kept THEN latitude ELSE coalesce(lat, latitude) END
                  AS latitude, CASE WHEN kept THEN longitude ELSE lon END AS longitude
       FROM (SELECT *, longitude IS NOT NULL AS kept FROM
              (SELECT c_custkey, c_nationkey, 'NATION_' || c_nationkey AS name,
                      c_acctbal AS latitude,
                      CASE WHEN c_mktsegment <> 'BUILDING' THEN 100.5::DOUBLE END AS longitude
               FROM customer))
       JOIN (SELECT n_nationkey,
                    CASE WHEN r_name <> 'ASIA' THEN n_nationkey + 0.25::DOUBLE
                         WHEN NOT regexp_matches(n_name, '[01]$') THEN n_nationkey + 0.75::DOUBLE
                    END AS lat,
                    CASE WHEN r_name <> 'ASIA' THEN n_regionkey + 0.5::DOUBLE
                         WHEN NOT regexp_matches(n_name, '[01]$') THEN 99.0::DOUBLE END AS lon
             FROM nation JOIN region ON r_regionkey = n_regionkey) ON n_nationkey = c_nationkey""",
)
def _lookup(t):
    rows = t.customer.select(
        "c_custkey",
        F.concat(F.lit("NATION_"), "c_nationkey").alias("name"),
        F.col("c_acctbal").alias("latitude"),
        F.when(F.col("c_mktsegment") != "BUILDING", 100.5).alias("longitude"),
    )
    return lookup(rows, locate, "name", nation_gazetteer(t), pause=0, pause_between=0)


@query(
    "lookup_status",
    """SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN NULL WHEN r_name <> 'ASIA' THEN 'known'
                              WHEN n_name LIKE '%0' THEN 'failed' WHEN n_name LIKE '%1' THEN 'not found'
                              ELSE 'found' END AS status
       FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
def _lookup_status(t):
    rows = t.customer.select(
        "c_custkey",
        F.concat(F.lit("NATION_"), "c_nationkey").alias("name"),
        F.col("c_acctbal").alias("latitude"),
        F.when(F.col("c_mktsegment") != "BUILDING", 100.5).alias("longitude"),
    )
    located = lookup(rows, locate, "name", nation_gazetteer(t), pause=0, pause_between=0, status_col="status")
    return located.select("c_custkey", "status")


def photo_rule(request: str, photos: list[dict]) -> str:
    """Stands in for a model that looks at pictures: answers for those only, with what it saw."""
    return json.dumps([{"id": p["ticket_id"], "label": 1, "reasoning": f"{p['pos']} {p['photo']}"} for p in photos])


@query(
    "label_photos",
    """WITH numbered AS (SELECT page_id, url, row_number() OVER (ORDER BY page_id) - 1 AS rn FROM pages
                         WHERE page_id % 3 <> 2)
       SELECT CAST(page_id AS VARCHAR) AS ticket_id,
              CASE WHEN page_id % 3 = 0 THEN 'Sufficient' ELSE 'Missing in JSON Response' END AS llm_label,
              CASE WHEN page_id % 3 = 0 THEN (rn % 20 + 1) || ' ' || url
                   ELSE 'Missing result in JSON response' END AS llm_reasoning
       FROM numbered""",
)
def _label_photos(t):
    """A photo alone for a third of the pages, a comment alone for a third, neither for the rest."""
    kind = F.col("page_id") % 3
    rows = t.pages.select(
        "page_id", F.when(kind == 0, F.col("url")).alias("photo"), F.when(kind == 1, F.col("url")).alias("comment"))
    return label_rows(pending_rows(rows), photo_rule, ["page_id"], "page_id").select(
        "ticket_id", "llm_label", "llm_reasoning")
