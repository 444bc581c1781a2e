"""Predicates, projections and schema helpers."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.functions.labels import label_status
from civicloom.operators.numbering import number_rows


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def filter_time_range(
    df: DataFrame,
    start: datetime,
    end: datetime,
    ts_col: str = "timestamp",
    day_col: str | None = None,
) -> DataFrame:
    """Rows from start to end, both included. The bounds take the column's own type, so the
    column stays bare and the range reaches the Parquet scan; on a table partitioned by
    ``day_col`` the days outside are not even listed."""
    if start > end:
        raise ValueError(f"start {start} lies after end {end}")
    dtype = df.schema[ts_col].dataType
    if day_col:
        df = df.filter(F.col(day_col).between(F.lit(start.date()), F.lit(end.date())))
    return df.filter(F.col(ts_col).between(F.lit(start).cast(dtype), F.lit(end).cast(dtype)))


def filter_province(df: DataFrame, province_col: str, province: str) -> DataFrame:
    """Rows of one province; all rows if there is no such column."""
    return df.filter(F.col(province_col) == province) if province_col in df.columns else df


def trim_column_names(df: DataFrame) -> DataFrame:
    """Blanks round column names go; two names that become one are an error."""
    names = [name.strip() for name in df.columns]
    doubled = sorted({name for name in names if names.count(name) > 1})
    if doubled:
        raise ValueError(f"column names are the same once trimmed: {doubled}")
    return df.toDF(*names)


def ensure_columns(
    df: DataFrame,
    order_by: Iterable[str],
    id_col: str = "ticket_id",
    type_col: str = "type",
    default_type: str = "ไม่ระบุ",
) -> DataFrame:
    """A missing id becomes ``ticket_0``, ``ticket_1``, ... in the order given, a missing type
    a constant."""
    if id_col not in df.columns:
        numbered = number_rows(df, list(order_by), "_row_number")
        place = (F.col("_row_number") - 1).cast("string")
        df = numbered.withColumn(id_col, F.concat(F.lit("ticket_"), place)).drop("_row_number")
    if type_col not in df.columns:
        df = df.withColumn(type_col, F.lit(default_type))
    return df


def resolve_column(
    df: DataFrame, name: str, tokens: Iterable[str] = (), position: int | None = None
) -> str:
    """The column of that name, else the first whose name holds a token, else, only if the
    caller gives one, the column at a position."""
    if name in df.columns:
        return name
    tokens = [token.lower() for token in tokens]
    for candidate in df.columns:
        if any(token in candidate.lower() for token in tokens):
            return candidate
    if position is not None:
        return df.columns[position]
    raise ValueError(f"no column {name!r} in {df.columns}")


def filter_has_evidence(
    df: DataFrame, comment_col: str = "comment", photo_col: str = "photo"
) -> DataFrame:
    """Rows with a comment or a photo."""
    return df.filter(F.col(comment_col).isNotNull() | F.col(photo_col).isNotNull())


def drop_sentinel_row(df: DataFrame, id_col: str = "_id", sentinel: int = 1) -> DataFrame:
    """Rows whose id is another than the sentinel; rows without an id go too."""
    return df.filter(F.col(id_col) != sentinel)


def filter_known_districts(
    df: DataFrame,
    districts: DataFrame,
    th_col: str = "amp_th",
    en_col: str = "amp_en",
) -> DataFrame:
    """Rows whose Thai or English name is a known one. The names are made distinct, so that
    the look-ups never multiply rows. Nothing runs until the rows are asked for."""
    known_th = districts.select(th_col).dropna().distinct()
    known_en = districts.select(en_col).dropna().distinct()
    marked = df.join(known_th.withColumn("_th", F.lit(True)), th_col, "left").join(
        known_en.withColumn("_en", F.lit(True)), en_col, "left"
    )
    return marked.filter(F.coalesce("_th", "_en", F.lit(False))).select(*df.columns)


def split_by_status(df: DataFrame, label_col: str = "llm_label") -> DataFrame:
    """Adds ``status``: cached, new or retry; without a label column all rows are new."""
    if label_col not in df.columns:
        return df.withColumn("status", F.lit("new"))
    return df.withColumn("status", label_status(F.col(label_col)))


def has_coordinates(lat_col: str = "latitude", lon_col: str = "longitude") -> Column:
    return F.col(lat_col).isNotNull() & F.col(lon_col).isNotNull()


def coordinate_report(
    df: DataFrame, lat_col: str = "latitude", lon_col: str = "longitude"
) -> DataFrame:
    """One row: ``rows``, ``located`` ones among them, and ``none_located``, for a map that would
    come out empty."""
    require_columns(df, lat_col, lon_col)
    counted = df.agg(
        F.count("*").alias("rows"), F.count_if(has_coordinates(lat_col, lon_col)).alias("located")
    )
    return counted.withColumn("none_located", (F.col("rows") > 0) & (F.col("located") == 0))


def filter_has_coordinates(
    df: DataFrame, lat_col: str = "latitude", lon_col: str = "longitude"
) -> DataFrame:
    require_columns(df, lat_col, lon_col)
    return df.filter(has_coordinates(lat_col, lon_col))


def marker_rows(
    df: DataFrame,
    name_col: str,
    phone_col: str,
    name_position: int | None = None,
    phone_position: int | None = None,
    lat_col: str = "latitude",
    lon_col: str = "longitude",
) -> DataFrame:
    """One row per located place: latitude, longitude, name and phone."""
    name = resolve_column(df, name_col, position=name_position)
    phone = resolve_column(df, phone_col, position=phone_position)
    return filter_has_coordinates(df, lat_col, lon_col).select(
        F.col(lat_col).alias("latitude"),
        F.col(lon_col).alias("longitude"),
        F.col(name).alias("name"),
        F.col(phone).alias("phone"),
    )
