"""Joins against labels, districts and gazetteers.

No side is broadcast by hint. What a large table is joined with is read from a file or from a
written table, so Catalyst knows its size: below ``autoBroadcastJoinThreshold`` the large table
is not shuffled at all, and beyond it both sides are shuffled straight from a scan, where
adaptive execution can split the partitions a hot key makes too large (it cannot do so above an
aggregate). Rows whose key is null can match nothing and are spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicloom.functions.text import present_flag
from civicloom.operators.aggregate import last_wins_dedupe
from civicloom.operators.filters import has_coordinates
from civicloom.session import pin

LABEL, REASON = "llm_label", "llm_reasoning"


def left_join_once(left: DataFrame, right: DataFrame, key: str, wanted: Column | None = None) -> DataFrame:
    """``left`` with the other columns of ``right`` by ``key``, in one pass over ``left``.

    Rows without a key, or not ``wanted``, can match nothing: they get a null key and are dealt
    over the tasks by a hash of their other columns instead of meeting in one.
    """
    there = F.col(key).isNotNull()
    there = there if wanted is None else there & F.coalesce(wanted, F.lit(False))
    plain = [F.col(f.name) for f in left.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    keyed = left.withColumns({
        "_key": F.when(there, F.col(key)),
        "_spread": F.when(there, F.lit(0).cast("bigint")).otherwise(F.xxhash64(*plain)),
    })
    found = right.withColumnRenamed(key, "_key").withColumn("_spread", F.lit(0).cast("bigint"))
    return keyed.join(found, ["_key", "_spread"], "left").drop("_key", "_spread")


def merge_labels_replace(
    table: DataFrame,
    labels: DataFrame,
    id_col: str = "ticket_id",
    label_col: str = LABEL,
    reason_col: str = REASON,
) -> DataFrame:
    """Labels of this run only: earlier ones are dropped, repeated ids multiply rows."""
    new = labels.select(id_col, label_col, reason_col)
    bare = table.drop(label_col, reason_col)
    return left_join_once(bare, new, id_col)


def merge_labels_upsert(
    table: DataFrame,
    labels: DataFrame,
    order_by: Sequence[str],
    id_col: str = "ticket_id",
    label_col: str = LABEL,
    reason_col: str = REASON,
) -> DataFrame:
    """New labels win, earlier ones stay; of several new ones the last in the order counts,
    so the table keeps its rows."""
    unique = last_wins_dedupe(
        labels.filter(F.col(id_col).isNotNull()).select(id_col, label_col, reason_col, *order_by),
        [id_col],
        order_by,
    )
    new = pin(unique, "labels").select(
        F.col(id_col).cast(table.schema[id_col].dataType).alias(id_col),
        F.struct(label_col, reason_col).alias("_new"),
    )
    for name in (label_col, reason_col):
        if name not in table.columns:
            table = table.withColumn(name, F.lit(None).cast("string"))

    def pick(name: str) -> Column:
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}")).otherwise(F.col(name))

    return left_join_once(table, new, id_col).select(
        *[
            pick(name).alias(name) if name in (label_col, reason_col) else F.col(name)
            for name in table.columns
        ]
    )


def district_zero_fill(
    districts: DataFrame, stats: DataFrame, name_col: str, key: str, zeros: Sequence[str]
) -> DataFrame:
    """Every district with its statistics, 0 where there are none. ``stats`` has one row per
    key."""
    found = stats.select(F.col(key).alias(name_col), *zeros)
    return districts.join(found, name_col, "left").na.fill(0, list(zeros))


def district_two_key_lookup(
    districts: DataFrame,
    stats: DataFrame,
    key: str,
    values: Sequence[str],
    en_col: str = "amp_en",
    th_col: str = "amp_th",
    zero_falls_through: bool = False,
) -> DataFrame:
    """Statistics under the English name, else under the Thai one, else 0.

    The Thai name is tried where the English one is unknown or, with ``zero_falls_through``
    (one value column), where it has a 0. ``stats`` has one row per key.
    """
    by_en = stats.select(F.col(key).alias(en_col), F.struct(*values).alias("_en"))
    by_th = stats.select(F.col(key).alias(th_col), F.struct(*values).alias("_th"))
    both = districts.join(by_en, en_col, "left").join(by_th, th_col, "left")
    usable = F.col("_en").isNotNull()
    if zero_falls_through:
        usable = usable & (F.col(f"_en.{values[0]}") != 0)
    picked = F.when(usable, F.col("_en")).otherwise(F.col("_th"))
    return both.select(
        *districts.columns,
        *[F.coalesce(picked[name], F.lit(0)).alias(name) for name in values],
    )


def translate_names(
    df: DataFrame, names: DataFrame, col: str, th_col: str = "amp_th", en_col: str = "amp_en",
    name: str = "district_en",
) -> DataFrame:
    """Adds the English name; a name without translation stays as it is."""
    known = names.select(F.col(th_col).alias(col), F.col(en_col).alias("_en"))
    return df.join(known, col, "left").select(
        *df.columns, F.coalesce("_en", F.col(col)).alias(name)
    )


def enrich_coordinates(
    df: DataFrame,
    gazetteer: DataFrame,
    name_col: str,
    gazetteer_name: str = "name",
    lat_col: str = "latitude",
    lon_col: str = "longitude",
) -> DataFrame:
    """Fill missing coordinates by name. Rows that have both, or no name, match nothing;
    a name that is listed twice counts with its smallest pair."""
    places = (
        gazetteer.filter(has_coordinates(lat_col, lon_col))
        .groupBy(F.col(gazetteer_name).alias(name_col))
        .agg(F.min(F.struct(F.col(lat_col).alias("lat"), F.col(lon_col).alias("lon"))).alias("_at"))
    )
    wanted = ~has_coordinates(lat_col, lon_col) & present_flag(F.col(name_col))
    found = left_join_once(df, pin(places, "gazetteer"), name_col, wanted)
    filled = {
        lat_col: F.coalesce("_at.lat", F.col(lat_col)),
        lon_col: F.coalesce("_at.lon", F.col(lon_col)),
    }
    return found.select(
        *[filled[name].alias(name) if name in filled else F.col(name) for name in df.columns]
    )


def attach_feature_stats(
    features: DataFrame, stats: Sequence[str], properties: Sequence[str] = ("amp_en", "amp_th")
) -> DataFrame:
    """One GeoJSON feature per row, the statistics among its properties. Joined by line breaks
    (``df.write.text``) the rows are newline-delimited GeoJSON of any size."""
    geometry = F.try_parse_json(F.col("geometry"))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*properties, *stats).alias("properties"),
        geometry.alias("geometry"),
    )
    return features.select(*properties, F.to_json(feature).alias("feature"))


def union_cached_and_new(cached: DataFrame, new: DataFrame) -> DataFrame:
    """Rows kept from earlier and rows labelled now, columns matched by name."""
    return cached.unionByName(new, allowMissingColumns=True)
