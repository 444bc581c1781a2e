"""Complaint and reference tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicloom.functions.text import parse_timestamp
from civicloom.operators.filters import drop_sentinel_row, require_columns
from civicloom.sources.files import exists, largest_file
from civicloom.sources.splitcsv import split_records

COORDINATES = ("latitude", "longitude")


def read_csv_by_name(
    spark: SparkSession, path: str, schema: T.StructType, bad_col: str | None = None, split: bool = False, **options
) -> DataFrame:
    """CSV with a header, its columns found by their names in it, blanks round them aside.

    Declared columns come first, with their types, then the others of the file as text. A declared
    column the file lacks is an error, as is a name that occurs twice; files of one folder must
    agree in their headers, which is checked while they are read. ``bad_col`` adds a column with
    the text of records that do not fit, null for the others (see ``count_bad_records``).
    ``split`` cuts files with quoted line breaks into many tasks (see ``sources.splitcsv``).
    """
    found = spark.read.csv(path, header=True, **options).columns
    by_name = {name.strip().lstrip("\ufeff").strip(): name for name in found}
    if len(by_name) < len(found):
        raise ValueError(f"two columns of {path} have one name: {found}")
    wanted = {field.name.strip(): field for field in schema.fields}
    if missing := [name for name in wanted if name not in by_name]:
        raise ValueError(f"{path} has no column {missing}; it has {list(by_name)}")
    read = T.StructType()
    for name, spelled in by_name.items():
        read = read.add(spelled, wanted[name].dataType if name in wanted else T.StringType())
    if split:
        df = _split_csv(spark, path, found, read, bad_col, options)
    else:
        reader = spark.read.option("enforceSchema", "false")
        if bad_col is not None:
            reader = reader.option("columnNameOfCorruptRecord", bad_col)
            read = read.add(bad_col, T.StringType())
        df = reader.schema(read).csv(path, header=True, **options)
    others = [name for name in by_name if name not in wanted]
    kept = [F.col(f"`{by_name[name]}`").alias(name) for name in [*wanted, *others]]
    return df.select(*kept, *([] if bad_col is None else [bad_col]))


def _split_csv(
    spark: SparkSession, path: str, header: list[str], read: T.StructType, bad_col: str | None, options: dict
) -> DataFrame:
    plain = {name: str(value).lower() if isinstance(value, bool) else value for name, value in options.items()}
    places = [f"c{k}" for k in range(len(header))]
    typed = ", ".join(f"{place} {field.dataType.simpleString()}" for place, field in zip(places, read.fields))
    if bad_col is not None:
        typed += ", bad string"
        plain["columnNameOfCorruptRecord"] = "bad"
    names = F.from_csv("record", ", ".join(f"{place} string" for place in places), plain)
    agrees = F.array(*[names[place] for place in places]) == F.array(*[F.lit(name.lstrip("\ufeff")) for name in header])
    other = F.concat(F.lit(f"a file of {path} has another header than {header}: "), F.col("record"))
    body = F.when(~F.col("head"), True).otherwise(
        F.when(F.coalesce(agrees, F.lit(False)), False).otherwise(F.raise_error(other).cast("boolean")))
    rows = split_records(spark, path).where(body).select(F.from_csv("record", typed, plain).alias("row"))
    columns = [F.col(f"row.{place}").alias(name) for place, name in zip(places, header)]
    return rows.select(*columns, *([] if bad_col is None else [F.col("row.bad").alias(bad_col)]))


def count_bad_records(df: DataFrame, bad_col: str) -> DataFrame:
    """One row: ``records``, and ``bad`` ones among them, of a frame read with ``bad_col``."""
    # A record is bad by its columns, so all of them have to be read: this is true of any hash.
    every_column = (F.xxhash64(*[f"`{c}`" for c in df.columns if c != bad_col]) % 2).between(-1, 1)
    bad = F.col(bad_col).isNotNull() & every_column
    return df.agg(F.count("*").alias("records"), F.count_if(bad).alias("bad"))


def read_complaints_csv(
    spark: SparkSession, path: str, schema: T.StructType, bad_col: str | None = None, split: bool | None = None
) -> DataFrame:
    """CSV with a header, quoted line breaks, and ``"`` doubled inside quotes; columns by name.

    Files larger than one read task (``spark.sql.files.maxPartitionBytes``) are cut into many, the
    others are a task each; ``split`` says which way to go whatever the sizes. Both give the same
    rows. Cut files must end their lines with a line feed, with or without a carriage return.
    """
    if split is None:
        size = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
        split = largest_file(spark, path) > size
    return read_csv_by_name(spark, path, schema, bad_col, split, multiLine=True, quote='"', escape='"')


def read_reference_csv(
    spark: SparkSession, path: str, schema: T.StructType, bad_col: str | None = None
) -> DataFrame:
    """CSV with a header and one record a line; columns by name, blanks round the names go."""
    return read_csv_by_name(spark, path, schema, bad_col, encoding="UTF-8")


def read_enriched_or_raw(
    spark: SparkSession, preferred: str, fallback: str, schema: T.StructType
) -> DataFrame:
    """The file with coordinates if it is there, else the raw one with null coordinates."""
    enriched = T.StructType(
        schema.fields + [T.StructField(name, T.DoubleType(), True) for name in COORDINATES]
    )
    if exists(spark, preferred):
        return read_reference_csv(spark, preferred, enriched)
    if not exists(spark, fallback):
        raise FileNotFoundError(f"neither {preferred} nor {fallback} is there")
    raw = read_reference_csv(spark, fallback, schema)
    return raw.withColumns({name: F.lit(None).cast("double") for name in COORDINATES})


def read_complaints(spark: SparkSession, path: str, ts_col: str = "timestamp") -> DataFrame:
    """Parquet complaints; the time column must exist and leaves as a timestamp.

    A column that is a timestamp already is left alone, so that range filters reach the scan.
    """
    df = spark.read.parquet(path)
    require_columns(df, ts_col)
    if isinstance(df.schema[ts_col].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df
    return df.withColumn(ts_col, parse_timestamp(F.col(ts_col)))


class ReferenceTables:
    """The reference tables by name, each read when it is first asked for."""

    def __init__(self, spark: SparkSession, readers: dict[str, Callable[[], DataFrame]]):
        self._spark = spark
        self._readers = readers
        self._frames: dict[str, DataFrame] = {}

    def dataset(self, name: str) -> DataFrame:
        """The table, which from then on is a view of that name in SQL as well."""
        if name not in self._readers:
            raise KeyError(f"no dataset {name!r}; known: {sorted(self._readers)}")
        if name not in self._frames:
            frame = self._readers[name]()
            frame.createOrReplaceTempView(name)
            self._frames[name] = frame
        return self._frames[name]

    def all(self) -> dict[str, DataFrame]:
        return {name: self.dataset(name) for name in self._readers}


def reference_tables(
    spark: SparkSession,
    *,
    hospitals: tuple[str, str, T.StructType],
    fire_stations: tuple[str, str, T.StructType],
    fire_incidents: tuple[str, T.StructType],
    population: tuple[str, T.StructType],
) -> ReferenceTables:
    """Hospitals and stations as (enriched path, raw path, schema), the others as (path, schema).

    The first record of the incident file repeats the headings and is left out.
    """
    return ReferenceTables(
        spark,
        {
            "hospitals": lambda: read_enriched_or_raw(spark, *hospitals),
            "fire_stations": lambda: read_enriched_or_raw(spark, *fire_stations),
            "fire_incidents": lambda: drop_sentinel_row(
                read_reference_csv(spark, *fire_incidents), "_id"
            ),
            "population": lambda: read_reference_csv(spark, *population),
        },
    )
