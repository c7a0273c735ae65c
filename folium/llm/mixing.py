"""Mixing of sources to target weights: each document comes a Poisson number of times, in a global random order.

The number is the inverse of the Poisson distribution at a point that a hash of the whole row, its number among
equal rows and a seed gives, so that any task draws the same number again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folium.llm.columns import free_names, numbered
from folium.llm.scratch import Scratch

#: Without given weights a source weighs its number of documents to this power.
TEMPERATURE = 0.5
#: Rates above this are drawn as sums of several numbers, so that exp(-rate) stays exact.
MAX_RATE = 100.0
#: Equal rows are numbered in groups of about so many.
EQUAL_ROWS = 4096


def _point(*parts: Column) -> Column:
    """A number from 0 up to 1, from the md5 of the parts: 52 bits of it."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def rates(docs: DataFrame, source: str = "source", weights: dict[str | None, float] | None = None, size: float = 1.0) -> DataFrame:
    """Of each source: n documents, target share, and rate, the mean number of times that a document is to come.

    The shares are the weights of the sources that have documents, made to sum to 1; sources that `weights`
    doesn't name get none. `size` is the number of documents drawn on average, as a multiple of those there are.
    """
    counted = docs.select(F.col(source).alias("src")).groupBy("src").agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(TEMPERATURE))
    else:
        if any(w < 0 for w in weights.values()):
            raise ValueError("weights must not be negative")
        weight = F.lit(0.0)
        for k, w in weights.items():
            weight = F.when(F.col("src").eqNullSafe(F.lit(k)), float(w)).otherwise(weight)
    counted = Scratch(docs.sparkSession).keep(counted.withColumn("weight", weight))
    total = counted.agg(F.sum("weight").alias("weight"), F.sum("n").alias("n")).first()
    if not total["weight"]:
        return counted.selectExpr("src", "n", "0d as share", "0d as rate")
    share = F.col("weight") / F.lit(total["weight"])
    return counted.select("src", "n", share.alias("share"), (share * F.lit(size * total["n"]) / F.col("n")).alias("rate"))


def digest(columns: list[Column]) -> Column:
    """md5 of a row's values as text, in order; nulls differ from all texts."""
    return F.md5(F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n")) for c in columns)))


def _numbered_equals(rows: DataFrame) -> DataFrame:
    """`rows` with digest and number: 0 for rows unlike all others, 1, 2, ... among equal ones.

    Only equal rows are shuffled, and a group of any size is dealt to several tasks, each of which numbers its part
    behind those before; which of two equal rows has which number makes no difference.
    """
    spark = rows.sparkSession
    own = rows.columns
    rows = rows.withColumn("digest", digest([F.col(c) for c in own]))
    repeated = Scratch(spark).keep(rows.groupBy("digest").agg(F.count("*").alias("equals")).filter("equals > 1"))
    single = rows.join(repeated, "digest", "left_anti").select(*own, "digest", F.lit(0).cast("long").alias("number"))
    many = rows.join(repeated, "digest").withColumn("deal", F.expr(f"pmod(monotonically_increasing_id(), ceil(equals / {EQUAL_ROWS}))"))
    many = many.withColumn("number", F.row_number().over(Window.partitionBy("digest", "deal").orderBy(F.lit(0))))
    many = Scratch(spark).keep(many.select(*own, "digest", "deal", "number"))
    before = Window.partitionBy("digest").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)
    deals = many.groupBy("digest", "deal").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    many = many.join(deals, ["digest", "deal"]).select(*own, "digest", (F.col("before") + F.col("number")).alias("number"))
    return single.unionByName(many)


def mix(docs: DataFrame, source: str = "source", weights: dict[str | None, float] | None = None, size: float = 1.0, seed: int = 0, shuffled: bool = True) -> DataFrame:
    """All columns of docs, each row as often as drawn, with copy (from 1), copies, rate and place, the global order.

    Rows are in the order of `place`, dealt to tasks by equal ranges of it. Every row is drawn by itself, whatever its
    id: rows with null or equal ids, and rows that are equal throughout, draw different numbers. A null source is a
    source of its own. No rows give no rows; texts of any length play no part but for the draw. Of the new columns,
    those whose names docs has get underscores.
    """
    names = free_names(docs.columns, ("copy", "copies", "rate", "place"))
    own = [f"c{k}" for k in range(len(docs.columns))]
    src = F.col(f"c{docs.columns.index(source)}")
    table = rates(docs, source, weights, size)
    # cumulated probabilities of 0, 1, 2, ... for one part of the rate; beyond the last the rest is below 1e-16
    parts = f"cast(greatest(1, ceil(rate / {MAX_RATE})) as int)"
    table = table.selectExpr("src", "rate", f"{parts} as parts", f"rate / {parts} as m")
    last = "cast(ceil(m + 12 * sqrt(m) + 20) as int)"
    steps = f"aggregate(sequence(1, {last}), struct(exp(-m) as p, array(exp(-m)) as c), (a, k) -> struct(a.p * m / k as p, array_append(a.c, a.c[k - 1] + a.p * m / k) as c), a -> a.c)"
    # a row for each source; where the planner doesn't send it to all tasks, Spark can split a large source
    table = Scratch(docs.sparkSession).keep(table.selectExpr("src", "rate", "parts", f"{steps} as cdf"))
    key = F.concat_ws(":", "digest", F.col("number").cast("string"))
    drawn = _numbered_equals(numbered(docs)).join(table, src.eqNullSafe(F.col("src")), "left")
    count = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda a, i: a + F.size(F.filter("cdf", lambda c: c <= _point(F.lit(str(seed)), key, i.cast("string")))))
    drawn = drawn.select(*own, "rate", count.alias("copies"), key.alias("key")).filter("copies > 0")
    drawn = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    order = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"place {seed}"), F.col("key"), F.col("copy").cast("string"))), 1, 15), 16, 10).cast("long")
    drawn = drawn.select(*own, "copy", "copies", "rate", order.alias("place"))
    if shuffled:
        # places are even over 60 bits, so equal ranges need no sampling pass
        tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        drawn = drawn.repartitionById(tasks, F.floor(F.col("place") / F.lit(2.0**60) * tasks).cast("int")).sortWithinPartitions("place")
    return drawn.toDF(*docs.columns, *names)
