"""Exact stratified samples without sorting the table.

Members are the first rows of a stratum by ``md5(id|seed)``. The hash is uniform, so its first
digits cut every stratum, a hot one too, into equal buckets. One aggregate counts the buckets;
running sums over the counts say how many rows each bucket gives; and only rows of buckets
that give any are shuffled and ranked, bucket by bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicloom.operators.numbering import number_rows
from civicloom.session import pin

# A stratum is cut into about so many buckets for each thousand rows drawn.
BUCKETS_PER_THOUSAND = 16


def bucket_digits(n: int) -> int:
    """Hexadecimal digits of the hash that name a bucket: their number follows what is drawn, so
    the list of buckets stays far shorter than the sample."""
    wanted, digits = max(1, n // 1000 * BUCKETS_PER_THOUSAND), 1
    while 16**digits < wanted:
        digits += 1
    return digits


_STRATUM, _HASH, _PREFIX, _SIZE, _NO_ID, _TAKE, _RANK = (
    "_stratum", "_hash", "_prefix", "_size", "_no_id", "_take", "_rank",
)


def sample_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))


def _hashed(
    df: DataFrame, id_col: str, stratum_col: str, seed: int, missing: str, digits: int
) -> DataFrame:
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit(missing))
    digest = sample_hash(id_col, seed)
    return df.withColumns({_STRATUM: stratum, _HASH: digest}).withColumn(
        _PREFIX, F.substring(_HASH, 1, digits)
    )


def _check(sizes: DataFrame, n: int) -> None:
    """The rejections of a stratified split into ``n`` rows and the rest."""
    facts = sizes.agg(
        F.coalesce(F.sum(_SIZE), F.lit(0)).alias("rows"),
        F.count("*").alias("strata"),
        F.min(_SIZE).alias("smallest"),
        F.sum(_NO_ID).alias("without_id"),
    ).first()
    if facts["without_id"]:
        raise ValueError(f"{facts['without_id']} rows have no id")
    if n < 1 or n >= facts["rows"]:
        raise ValueError(f"cannot draw {n} of {facts['rows']} rows and leave a rest")
    if facts["smallest"] < 2:
        raise ValueError("a stratum has fewer than two rows")
    if min(n, facts["rows"] - n) < facts["strata"]:
        raise ValueError(f"{n} rows or the rest are fewer than the {facts['strata']} strata")


def quotas(sizes: DataFrame, n: int) -> DataFrame:
    """``n`` rows shared out by largest remainder, in whole numbers; equal remainders go by
    stratum. One row per stratum in and out."""
    total = sizes.agg(F.sum(_SIZE)).scalar()
    scaled = F.col(_SIZE).cast("decimal(38,0)") * F.lit(n).cast("decimal(20,0)")
    shared = sizes.select(_STRATUM, scaled.alias("_scaled"), total.alias("_total")).select(
        _STRATUM,
        F.expr("_scaled div _total").alias("_whole"),
        F.expr("_scaled % _total").alias("_rest"),
    )
    # Remainders are numbered by a global sort, so a million strata are not ranked in one task.
    shared = pin(shared, "shares")
    left = F.lit(n) - shared.agg(F.sum("_whole")).scalar()
    numbered = number_rows(shared.withColumn("_least", -F.col("_rest")), ["_least", _STRATUM], "_nth")
    extra = F.when(F.col("_nth") <= left, 1).otherwise(0)
    return numbered.select(_STRATUM, (F.col("_whole") + extra).cast("bigint").alias("_quota"))


def _ranked(
    df: DataFrame, n: int, stratum_col: str, id_col: str, seed: int, missing: str, all_rows: bool
) -> DataFrame:
    hashed = _hashed(df, id_col, stratum_col, seed, missing, bucket_digits(n))
    counted = hashed.groupBy(_STRATUM, _PREFIX).agg(
        F.count("*").alias(_SIZE), F.count_if(F.col(id_col).isNull()).alias(_NO_ID)
    )
    buckets = pin(counted, "buckets")
    sizes = buckets.groupBy(_STRATUM).agg(
        F.sum(_SIZE).alias(_SIZE), F.sum(_NO_ID).alias(_NO_ID)
    )
    _check(sizes, n)
    earlier = (
        Window.partitionBy(_STRATUM).orderBy(_PREFIX).rowsBetween(Window.unboundedPreceding, -1)
    )
    open_places = F.col("_quota") - F.coalesce(F.sum(_SIZE).over(earlier), F.lit(0))
    take = F.greatest(F.lit(0), F.least(F.col(_SIZE), open_places))
    taken = buckets.join(quotas(sizes, n), _STRATUM).select(
        _STRATUM, _PREFIX, take.alias(_TAKE)
    )
    if not all_rows:
        taken = taken.filter(F.col(_TAKE) > 0)
    # The written buckets have a known size: Catalyst broadcasts them if they are small and else
    # joins on stratum and prefix, which no hot stratum can crowd.
    in_bucket = Window.partitionBy(_STRATUM, _PREFIX).orderBy(_HASH, id_col)
    return hashed.join(pin(taken, "taken"), [_STRATUM, _PREFIX]).withColumn(
        _RANK, F.row_number().over(in_bucket)
    )


def stratified_sample_exact(
    df: DataFrame,
    n: int,
    stratum_col: str,
    id_col: str,
    seed: int = 42,
    missing: str = "MISSING",
) -> DataFrame:
    """Exactly ``n`` rows, each stratum in proportion; a null stratum counts as one of its own.
    The id must be unique."""
    ranked = _ranked(df, n, stratum_col, id_col, seed, missing, all_rows=False)
    return ranked.filter(F.col(_RANK) <= F.col(_TAKE)).select(*df.columns)


def stratified_split(
    df: DataFrame,
    n: int,
    stratum_col: str,
    id_col: str,
    seed: int = 42,
    missing: str = "MISSING",
    name: str = "in_first",
) -> DataFrame:
    """All rows, with a flag that is true for ``n`` of them, drawn as above."""
    ranked = _ranked(df, n, stratum_col, id_col, seed, missing, all_rows=True)
    return ranked.select(*df.columns, (F.col(_RANK) <= F.col(_TAKE)).alias(name))
