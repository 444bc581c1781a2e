"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.session import pin


def components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """Rows ``(id, component_id)`` for every id that occurs in a link between two ids;
    ``component_id`` is the smallest id reachable. Links with a null end, links of an id to itself
    and repeated links are harmless; no links give no rows.

    Rounds of large stars and small stars: first every neighbour larger than an id is linked to
    the smallest neighbour, then every smaller one. The number of links does not grow, and the
    rounds end when all links point at the smallest id of a component, after about the logarithm
    of the longest path. Each round is written to the shared folder. The smallest neighbour is a
    partial aggregate, and ids with many links are spread by adaptive execution where it joins.
    """
    one, other = F.col(first), F.col(second)
    links = pin(
        links.where(one.isNotNull() & other.isNotNull() & (one != other))
        .select(F.greatest(one, other).alias("u"), F.least(one, other).alias("v")).distinct(),
        "links",
    )
    before = _state(links)
    while before[0]:
        both = links.union(links.select("v", "u"))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v").distinct()
        )
        large = pin(large, "large-stars")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
            .union(smallest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        links = pin(small, "small-stars")
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(
        links.select("v", "v").distinct())


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
    ).first())
