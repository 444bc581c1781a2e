"""Mixing sources to target weights by pivotal dependent rounding.

A document's expected number of copies is its source's target over its source's size. The whole
part is taken as it is; the fractional part becomes mass, in words. Documents of a source meet in
small groups. In a group two documents at a time trade mass, at random but without changing either
expectation, until one of them has none or all of its words; the other goes on. What is left of a
group, one document with the group's remaining mass, meets the rest of other groups on the next
level of a tree, up to one document for the source, which is rounded to the nearer side. Trades
keep the sum of words, so a source misses its target by at most half of that document.

Only DataFrame functions; groups hold a bounded number of documents whatever the size of a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicloom.llm.names import numbered
from civicloom.session import pin

# Documents that meet in one group, on average at the leaves and at most further up. Within a
# group the largest trade first, so that small ones are left to settle what remains.
GROUP_ROWS = 512
# Draws made for the last group of a source; the one that misses the target least counts.
LAST_DRAWS = 8

_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_repeats: float, *,
                   source_col: str = "source", size_col: str = "size") -> DataFrame:
    """One row per source: ``source_col``, ``source_no``, ``source_size``, ``source_rows``, ``target``.

    Sources in code-point order, null last, take ``weights`` in turn and share the sum of all
    sizes; no target exceeds ``max_repeats`` times its source, and what it cannot take goes to
    the others by weight. That level is found at once: with the sources sorted by the level at
    which each is full, it is the largest of the levels left when the first 0, 1, 2, ... are full.
    The windows see one row per source. An empty table has no sources.
    """
    sources = sizes.groupBy(F.col(source_col)).agg(
        F.sum(size_col).alias("source_size"), F.count("*").alias("source_rows"))
    everything = Window.partitionBy()
    in_order = Window.orderBy(F.col(source_col).asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("source_no") - 1) % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(float(max_repeats))
    fullest_first = Window.orderBy(F.col("_limit") / F.col("_weight"), "source_no").rowsBetween(
        Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum("_limit").over(fullest_first), F.lit(0.0))
    weighed = F.coalesce(F.sum("_weight").over(fullest_first), F.lit(0.0))
    return (
        sources.withColumn("source_no", F.row_number().over(in_order))
        .withColumn("_weight", weight)
        .withColumn("_limit", limit)
        .withColumn("_total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("_weights", F.sum("_weight").over(everything))
        .withColumn("_level", (F.col("_total") - used) / (F.col("_weights") - weighed))
        .withColumn("_level", F.max("_level").over(everything))
        .select(source_col, "source_no", "source_size", "source_rows",
                F.least("_limit", F.col("_weight") * F.col("_level")).alias("target"))
    )


def draw(units: DataFrame, weights: tuple[float, ...], max_repeats: float, seed: int, *,
         keys: list[str], source_col: str = "source", size_col: str = "size") -> DataFrame:
    """How often each unit is taken: ``units`` grouped by all its columns, with ``n_rows`` (equal
    rows are one unit), ``source_size``, ``target`` and ``copies`` (for the ``n_rows`` together).

    ``keys`` and the size decide the draw, together with ``seed``: reruns agree.
    """
    columns = units.columns
    lean = pin(units.groupBy(*columns).agg(F.count("*").alias("n_rows"))
               .withColumn("_words", F.col(size_col) * F.col("n_rows")), "mix-units")
    sources = pin(source_targets(lean, weights, max_repeats, source_col=source_col, size_col="_words"),
                  "mix-sources")
    expected = F.when(F.col("source_size") > 0,
                      F.col("target") / F.col("source_size") * F.col("n_rows")).otherwise(F.lit(0.0))
    leaves = F.greatest(F.ceil(F.col("source_rows") / GROUP_ROWS), F.lit(1))
    named = lean.withColumnRenamed(source_col, "_source_of_unit")
    rows = (
        named.join(sources, F.col("_source_of_unit").eqNullSafe(F.col(source_col)))
        .drop("_source_of_unit")
        .withColumn("_expected", expected)
        .withColumn("_whole", F.floor("_expected"))
        .withColumn("_tie", F.xxhash64(F.lit(seed), *keys, size_col, "n_rows"))
        .withColumn("_node", F.pmod(F.col("_tie"), leaves))
        .withColumn("_cap", F.col(size_col).cast("double"))
        .withColumn("_mass", (F.col("_expected") - F.col("_whole")) * F.col("_cap"))
    )
    payload = F.struct(*columns, "n_rows", "source_size", "target", "_whole").alias("unit")
    item = F.struct((-F.col("_cap")).alias("less"), F.col("_tie").alias("tie"),
                    F.col("_mass").alias("mass"), payload).alias("item")
    pending = rows.select("source_no", F.col("_node").alias("node"), item)
    largest = sources.agg(F.max("source_rows")).first()[0] or 1
    nodes, level, decided = -(-largest // GROUP_ROWS), 0, []
    while True:
        last = nodes <= 1
        met = pin(_meet(pending, seed, level, LAST_DRAWS if last else 1), f"mix-level-{level}")
        each = met.select("at", "picked", F.posexplode("items").alias("pos", "item"))
        decided.append(each.where(F.col("pos") != F.col("at")).select(
            "item.unit", F.array_contains("picked", F.col("pos")).cast("long").alias("more")))
        if last:
            rest = met.select(F.element_at("items", F.col("at") + 1).alias("item"), "mass")
            decided.append(rest.select(
                "item.unit", ((F.col("mass") > 0) & (F.col("mass") >= -F.col("item.less") / 2))
                .cast("long").alias("more")))
            break
        pending = met.select(
            "source_no", F.floor(F.col("node") / GROUP_ROWS).alias("node"),
            F.element_at("items", F.col("at") + 1).withField("mass", F.col("mass")).alias("item"))
        nodes, level = -(-nodes // GROUP_ROWS), level + 1
    result = decided[0]
    for more in decided[1:]:
        result = result.unionByName(more)
    return result.select("unit.*", "more").withColumn("copies", F.col("_whole") + F.col("more")).drop(
        "_whole", "more")


def _meet(pending: DataFrame, seed: int, level: int, draws: int) -> DataFrame:
    """One level: each group's items, largest first, with the places picked, and the place and
    mass of the item left over. Of several draws, the one whose rest is nearest to nothing or
    to the whole item."""
    groups = pending.groupBy("source_no", "node").agg(F.array_sort(F.collect_list("item")).alias("items"))
    start = F.struct(
        F.col("items")[0]["mass"].alias("mass"), F.lit(0).alias("at"),
        F.array().cast("array<int>").alias("picked"))

    def trade(draw_no: Column, state: Column, place: Column) -> Column:
        one, other = state["mass"], F.col("items")[place]["mass"]
        room_one = -F.col("items")[state["at"]]["less"] - one
        room_other = -F.col("items")[place]["less"] - other
        up, down = F.least(room_one, other), F.least(one, room_other)
        chance = (F.xxhash64(F.lit(seed), F.lit(level), draw_no, F.col("items")[place]["tie"], place)
                  .bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53)))
        rises = chance * (up + down) <= down
        # Rising, the first one fills up if the other can fill it, else it takes all the other has.
        # Falling, the first one empties if the other has room for it, else it fills the other.
        first_full = F.struct((other - room_one).alias("mass"), place.alias("at"),
                              F.concat(state["picked"], F.array(state["at"])).alias("picked"))
        other_empty = F.struct((one + other).alias("mass"), state["at"].alias("at"),
                               state["picked"].alias("picked"))
        first_empty = F.struct((one + other).alias("mass"), place.alias("at"),
                               state["picked"].alias("picked"))
        other_full = F.struct((one - room_other).alias("mass"), state["at"].alias("at"),
                              F.concat(state["picked"], F.array(place)).alias("picked"))
        return (
            F.when(rises & (room_one <= other), first_full)
            .when(rises, other_empty)
            .when(one <= room_other, first_empty)
            .otherwise(other_full)
        )

    later = F.expr("slice(sequence(0, size(items) - 1), 2, size(items))")
    def attempt(draw_no: Column) -> Column:
        return F.aggregate(later, start, lambda state, place: trade(draw_no, state, place))

    def judged(state: Column) -> Column:
        whole = -F.col("items")[state["at"]]["less"]
        return F.struct(F.least(state["mass"], whole - state["mass"]).alias("miss"), state["mass"].alias("mass"),
                        state["at"].alias("at"), state["picked"].alias("picked"))

    tried = F.transform(F.array(*[F.lit(k) for k in range(draws)]), attempt)
    best = F.array_min(F.transform(tried, judged))
    folded = groups.withColumn("_s", best)
    return folded.select("source_no", "node", "items", "_s.mass", "_s.at", "_s.picked")


def mixture(docs: DataFrame, weights: tuple[float, ...], max_repeats: float, seed: int, *,
            id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: ``id_col``, ``source_col``, ``size``, ``source_size``, ``target``
    (its source's), ``copies`` and ``taken`` words. Null texts have size 0; a null source is a
    source, the last. Rows that agree in id, source and size share their copies evenly. Documents
    of size 0 are taken as often as their source's whole part says. An empty table gives no rows."""
    units = docs.select(id_col, source_col, word_count(F.col(text_col)).alias("size"))
    drawn = draw(units, weights, max_repeats, seed, keys=[id_col], source_col=source_col)
    share = F.floor(F.col("copies") / F.col("n_rows")) + (
        F.col("_row") <= F.col("copies") % F.col("n_rows")).cast("long")
    return (
        drawn.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))))
        .withColumn("copies", share)
        .select(id_col, source_col, "size", "source_size", "target", "copies",
                (F.col("copies") * F.col("size")).alias("taken"))
    )


def mix(docs: DataFrame, weights: tuple[float, ...], max_repeats: float, seed: int, *,
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed documents: the rows of ``docs``, each as often as it is taken. Documents without
    words stay once: they have no part in any target."""
    plain, name = numbered(docs)
    rows = plain.select(
        "*", F.xxhash64(*plain.columns).alias("_key"), F.hash(F.lit(1), *plain.columns).alias("_check"))
    units = rows.select("_key", "_check", F.col(name[source_col]).alias("_source"),
                        word_count(F.col(name[text_col])).alias("_size"))
    drawn = draw(units, weights, max_repeats, seed, keys=["_key", "_check"], source_col="_source",
                 size_col="_size")
    copies = drawn.select(
        "_key", "_check",
        F.when(F.col("_size") > 0, F.col("copies")).otherwise(F.col("n_rows")).alias("_copies"),
    ).where("_copies > 0")
    return (
        rows.dropDuplicates(["_key", "_check"]).join(copies, ["_key", "_check"])
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
        .select(*plain.columns).toDF(*docs.columns)
    )
