"""Mixing sources to target weights.

Every row gets a hash-random key. Rows are dealt into ranges of that key within their source, sizes are summed per
(source, range), prefix sums over those ranges find the range in which a source's budget runs out, and a prefix sum
inside that one range finds the row. What a source cannot cover in one pass is repeated in whole epochs.

Defined results: a null text has size 0 and takes nothing; the null source is a source like any other and sorts last;
an empty table gives an empty result; rows with equal keys (repeated rows) share the words at the cut in proportion to
their size, rounded down; texts of any length count whole; extra columns, whatever their names, are ignored by
``mix_plan`` and kept by ``mix_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import apart, chosen, joined_small, materialize, word_count

WEIGHTS = (5.0, 2.0, 1.0)
#: Ranges of the random key per source: 2 ** RANGE_BITS.
RANGE_BITS = 14


def _key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.coalesce(F.col("source"), F.lit("\0null")), F.col("text"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights repeat over sources in code point order.

    The sum of all sizes is shared by weight; what lies above ``max_epochs`` times a source's size is shared again among
    the rest. Each round is one distributed sum, so any number of sources will do.
    """
    spark = sizes.sparkSession
    ordered = sizes.orderBy(F.col("source").asc_nulls_last())
    schema = T.StructType([T.StructField("source", T.StringType()), T.StructField("source_size", T.LongType()), T.StructField("ord", T.LongType())])
    ranked = spark.createDataFrame(ordered.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1])), schema)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("ord") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.select("source", "source_size", weight.alias("w"), (F.col("source_size") * F.lit(float(max_epochs))).alias("cap")), "mix-sources")
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    free = F.lit(True)
    level = 0.0
    while True:
        row = ranked.agg(F.sum(F.when(free, F.col("w"))).alias("w"), F.sum(F.when(~free, F.col("cap"))).alias("held")).first()
        if not row.w:
            break
        level = (total - (row.held or 0.0)) / row.w
        above = ranked.filter(free & (F.col("w") * level > F.col("cap"))).limit(1).count()
        if not above:
            break
        free = F.col("w") * F.lit(level) <= F.col("cap")
    return ranked.select("source", "source_size", F.least(F.col("w") * F.lit(level), F.col("cap")).alias("target"))


def mix_cuts(slim: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = 3, range_bits: int = RANGE_BITS) -> DataFrame:
    """One row per source: target, whole epochs, and the key at which the last, partial epoch ends.

    ``slim`` has source, key and size. ``cut_words`` are the words taken from rows that share the cut's key, whose
    sizes add up to ``cut_size``.
    """
    ranged = slim.withColumn("range", F.shiftrightunsigned("key", 64 - range_bits))
    sums = materialize(ranged.groupBy("source", "range").agg(F.sum("size").alias("size")), "mix-ranges")
    per_source = sums.groupBy("source").agg(F.sum("size").alias("source_size"))
    budgets = source_targets(per_source, weights, max_epochs).withColumn("budget", F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * max_epochs))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0)
    budgets = budgets.withColumn("epochs", whole.cast("long")).withColumn("rest", (F.col("budget") - F.col("epochs") * F.col("source_size")).cast("long")).drop("budget")
    budgets = materialize(budgets, "mix-budgets")
    before = F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    run = sums.withColumn("before", before)
    need = budgets.filter("rest > 0").select(F.col("source").alias("s"), "rest")
    at = run.join(need, run["source"].eqNullSafe(need["s"])).filter("before < rest and rest <= before + size")
    at = materialize(at.select("source", "range", (F.col("rest") - F.col("before")).alias("left")), "mix-at")
    inside = joined_small(ranged, at.select(F.col("source").alias("s"), F.col("range").alias("r"), "left"), F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")), "inner")
    by_key = inside.groupBy("source", "key").agg(F.sum("size").alias("cut_size"), F.first("left").alias("left"))
    run_in = F.coalesce(F.sum("cut_size").over(Window.partitionBy("source").orderBy("key_u").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = by_key.withColumn("key_u", _unsigned(F.col("key"))).withColumn("before", run_in).filter("before < left and left <= before + cut_size")
    cut = cut.select(F.col("source").alias("cut_source"), F.col("key_u").alias("cut_key"), (F.col("left") - F.col("before")).alias("cut_words"), "cut_size")
    return materialize(budgets.join(cut, budgets["source"].eqNullSafe(cut["cut_source"]), "left").drop("cut_source"), "mix-cuts")


def _unsigned(key: Column) -> Column:
    """Longs in the order of their unsigned values."""
    return key.bitwiseXOR(F.lit(-(1 << 63)))


def _slim(docs: DataFrame, seed: int) -> DataFrame:
    return chosen(docs, "doc_id", "source", "text").select("doc_id", "source", _key(seed).alias("key"), word_count(F.col("text")).alias("size"))


def _with_cuts(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    return joined_small(rows, cuts.withColumnRenamed("source", "cut_source"), F.col("source").eqNullSafe(F.col("cut_source"))).drop("cut_source")


def mix_plan(docs: DataFrame, seed: int = 17, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target and taken: the words the mix takes of each row, repeats counted."""
    slim = materialize(_slim(docs, seed), "mix-slim")
    rows = _with_cuts(slim, mix_cuts(slim, weights, max_epochs))
    key = _unsigned(F.col("key"))
    part = F.when(key < F.col("cut_key"), F.col("size")).when(key == F.col("cut_key"), F.floor(F.col("cut_words") * F.col("size") / F.col("cut_size"))).otherwise(0)
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"))


def mix_rows(docs: DataFrame, seed: int = 17, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """The rows of the mix with all columns of ``docs``, each repeated as often as it is taken.

    Texts stay whole: the row at the cut is taken once more if half of its words or more fit.
    """
    slim = materialize(_slim(docs, seed), "mix-slim")
    plain, places, names, at = apart(docs, ("doc_id", "source", "text"), ())
    needed = plain.select(*[F.col(p).alias(c) for c, p in at.items()], F.struct(*places).alias("row"))
    rows = needed.select("row", "source", _key(seed).alias("key"))
    rows = _with_cuts(rows, mix_cuts(slim, weights, max_epochs))
    key = _unsigned(F.col("key"))
    more = F.when((key < F.col("cut_key")) | ((key == F.col("cut_key")) & (F.col("cut_words") * 2 >= F.col("cut_size"))), 1).otherwise(0)
    copies = (F.col("epochs") + more).cast("int")
    rows = rows.withColumn("__copies", copies).filter("__copies > 0").select("row", F.explode(F.array_repeat(F.lit(0), F.col("__copies"))))
    return rows.select("row.*").toDF(*names)
