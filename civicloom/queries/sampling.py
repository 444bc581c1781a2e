"""Batches and exact samples over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicloom.operators.numbering import assign_batches
from civicloom.operators.sample import stratified_sample_exact, stratified_split
from civicloom.queries.registry import LABELED_DOCUMENTS, labeled_documents, query
from civicloom.session import pin


@query(
    "assign_batches",
    """SELECT event_id, ts, CAST((rn - 1) // 20 + 1 AS BIGINT) AS batch_num,
              CAST((rn - 1) % 20 + 1 AS INTEGER) AS pos
       FROM (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events)""",
)
def _assign_batches(t):
    return assign_batches(t.events.select("event_id", "ts"), ["ts", "event_id"])


def _sample_sql(name: str, rows: str, key: str, n: int, seed: int) -> str:
    """CTEs that end in ``name(key, stratum, picked)`` for all rows of ``rows(key, stratum)``."""
    return f"""
      {name}_sizes AS (SELECT stratum, count(*) AS c FROM {rows} GROUP BY stratum),
      {name}_parts AS (SELECT stratum, ({n} * c) // (SELECT sum(c) FROM {name}_sizes) AS whole,
                              ({n} * c) % (SELECT sum(c) FROM {name}_sizes) AS rest
                       FROM {name}_sizes),
      {name}_quota AS (SELECT stratum, whole + CASE WHEN
                         row_number() OVER (ORDER BY rest DESC, stratum)
                           <= {n} - (SELECT sum(whole) FROM {name}_parts) THEN 1 ELSE 0 END AS quota
                       FROM {name}_parts),
      {name} AS (SELECT {key}, stratum, row_number() OVER (PARTITION BY stratum
                          ORDER BY md5({key} || '|{seed}'), {key}) <= quota AS picked
                 FROM {rows} JOIN {name}_quota USING (stratum))
    """


DOCUMENT_STRATA = f"""{LABELED_DOCUMENTS},
    strata AS (SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'MISSING') AS stratum
               FROM complaints)"""
ORDER_STRATA = """
    strata AS (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority
                                       ELSE 'MISSING' END AS stratum FROM orders)"""


@query(
    "stratified_sample_exact",
    f"""WITH {DOCUMENT_STRATA}, {_sample_sql("sample", "strata", "doc_id", 120, 42)}
        SELECT doc_id, CASE WHEN stratum <> 'MISSING' THEN stratum END AS quality
        FROM sample WHERE picked""",
)
def _stratified_sample_exact(t):
    rows = labeled_documents(t).select("doc_id", F.col("quality").cast("string").alias("quality"))
    return stratified_sample_exact(rows, 120, "quality", "doc_id", 42)


def _orders(t):
    urgent = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", urgent.alias("priority"))


@query(
    "stratified_split",
    f"""WITH {ORDER_STRATA}, {_sample_sql("sample", "strata", "o_orderkey", 777, 42)},
          kept AS (SELECT o_orderkey, stratum FROM sample WHERE picked),
          {_sample_sql("halves", "kept", "o_orderkey", 200, 7)}
        SELECT o_orderkey, CASE WHEN stratum <> 'MISSING' THEN stratum END AS priority,
               picked AS in_first FROM halves""",
)
def _stratified_split(t):
    sample = pin(stratified_sample_exact(_orders(t), 777, "priority", "o_orderkey", 42), "sample")
    return stratified_split(sample, 200, "priority", "o_orderkey", 7)
