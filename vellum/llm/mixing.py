"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Sizes are words. Sources in code-point order (null last) weigh 5, 2, 1, repeating, and share the words of all
documents; a source never gets more than 3 times its own words, and the excess goes to the others by weight.
With ratio r = target / source size, each document is taken floor(r) times for certain. The rest is an unequal-
probability sample with inclusion odds p/(1-p), p = r - floor(r) of its source: documents rank by
u/(1-u) / (p/(1-p)), u uniform from a hash of doc_id, and the lowest ranks are taken while they fit into the rest
of the target; of the documents that follow, the one whose size is nearest to the words then left is taken too.
So the sample is fixed in words, the unit of the targets.

The rank at which a source stops is found without sorting a source: ranks fall into equal-chance bins, words are
summed per bin, and only the documents of the one bin that holds the limit are ordered. Decisions reach the rows
as a table of one row per source.

Defined results: null text has size 0; null doc_id draws one u; rows that repeat a doc_id share a u and are
ordered by size and a hash of the text, and rows alike in all are taken alike; a source without words has target 0; no rows give no rows. Extra columns stay unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
WORD = r"[^\x20\x09-\x0D]+"
#: Equal-chance bins of u per source. More rows per bin only make the ordered bin larger.
BINS = 1 << 14


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def chance(key: Column) -> Column:
    """A number in (0, 1) from the first 12 hex digits of the md5 of key."""
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 12), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def shares(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, source_size, target from one row per source (source, source_size).

    A source is at its cap when most * size / weight is below the level at which the rest fills up: with sources in
    rising order of that quotient, the level after k capped ones is (total - caps so far) / weights left.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")  # UTF-8 byte order is code-point order
    pick = F.array(*[F.lit(float(w)) for w in weights])
    # one row per source: a handful of rows, so one task orders them
    ranked = sources.withColumn("__w", F.element_at(pick, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("__cap", F.lit(most) * F.col("source_size")).withColumn("__q", F.col("__cap") / F.col("__w"))
    everyone = Window.partitionBy(F.lit(0))
    upto = Window.partitionBy(F.lit(0)).orderBy("__q", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everyone) - F.coalesce(F.sum("__cap").over(upto), F.lit(0.0))) / (
        F.sum("__w").over(everyone) - F.coalesce(F.sum("__w").over(upto), F.lit(0.0))
    )
    # the level falls to its final value at the first source that isn't capped, and is above q for every capped one
    ranked = ranked.withColumn("__level", level)
    final = F.min(F.when(F.col("__level") <= F.col("__q"), F.struct("__q", "__level"))).over(everyone)["__level"]
    target = F.when(F.col("__level") > F.col("__q"), F.col("__cap")).otherwise(final * F.col("__w"))
    return ranked.select("source", "source_size", F.coalesce(target, F.lit(0.0)).cast("double").alias("target"))


def mix(documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies and the columns in keep, for every row."""
    spark = documents.sparkSession
    docs = documents.select(
        "doc_id", F.col("source").cast("string").alias("source"), words_of(F.col("text")).alias("size"), F.struct(chance(F.col("doc_id")).alias("u"), "doc_id", words_of(F.col("text")).alias("size"), F.xxhash64("text").alias("t")).alias("__k"), *keep
    )
    sized = written(docs.select("source", "size", F.col("__k.u").alias("u"), "__k"), "sizes")
    plan = shares(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.withColumn("__r", ratio).withColumn("__whole", F.floor(F.col("__r") + F.lit(1e-12)).cast("long"))
    plan = plan.withColumn("__p", F.greatest(F.lit(0.0), F.col("__r") - F.col("__whole"))).withColumn("__need", F.col("__p") * F.col("source_size"))
    plan = written(plan.withColumnRenamed("source", "__s"), "shares")  # one row per source

    rows = _with(sized, plan.where("__p > 0")).withColumn("__bin", F.floor(F.col("u") * F.lit(BINS)).cast("int"))
    # p is the same within a source, so the rank u/(1-u) / (p/(1-p)) rises with u: bins of u are bins of the rank
    rank = (F.col("u") / (F.lit(1.0) - F.col("u"))) / (F.col("__p") / (F.lit(1.0) - F.col("__p")))
    sums = rows.groupBy("source", "__bin").agg(F.sum("size").alias("__words"), F.first("__need").alias("__need"))
    run = Window.partitionBy("source").orderBy("__bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = sums.withColumn("__upto", F.sum("__words").over(run)).where(F.col("__upto") > F.col("__need"))
    last = over.groupBy("source").agg(F.min(F.struct("__bin", (F.col("__upto") - F.col("__words")).alias("before"))).alias("__l"))
    last = written(last.select(F.col("source").alias("__s"), F.col("__l.__bin").alias("__last"), F.col("__l.before").alias("__before")), "limits")
    order = Window.partitionBy("source").orderBy("__rank", "__k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = _with(rows, last).where("__bin = __last").withColumn("__rank", rank).withColumn("__sum", F.col("__before") + F.sum("size").over(order))
    # the first document that doesn't fit, and the words still wanted before it
    stop = edge.where(F.col("__sum") > F.col("__need")).groupBy("source").agg(F.min(F.struct(F.col("__k").alias("k"), (F.col("__need") - F.col("__sum") + F.col("size")).alias("rest"))).alias("__l"))
    stop = written(stop.select(F.col("source").alias("__s"), F.col("__l.k").alias("__stop"), F.col("__l.rest").alias("__rest")), "stops")
    # of the documents from there on, the one whose size is nearest to those words fills the place
    miss = F.abs(F.col("size") - F.col("__rest"))
    fill = _with(sized, stop).where((F.col("__k") >= F.col("__stop")) & (miss < F.col("__rest"))).groupBy("source").agg(F.min(F.struct(miss.alias("miss"), "__k")).alias("__f"))
    fill = written(fill.select(F.col("source").alias("__s"), F.col("__f.__k").alias("__fill")), "fills")

    out = _with(_with(_with(docs, plan), stop, "left"), fill, "left")
    more = (F.col("__p") > 0) & (F.col("__stop").isNull() | (F.col("__k") < F.col("__stop")) | F.coalesce(F.col("__k") == F.col("__fill"), F.lit(False)))
    copies = F.col("__whole") + F.when(more, 1).otherwise(0)
    return out.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * copies).cast("long").alias("taken"), copies.cast("long").alias("copies"), *keep)


def _with(rows: DataFrame, per_source: DataFrame, how: str = "inner") -> DataFrame:
    """Join a table of one row per source. Such tables are read from files, so their size is known: Spark broadcasts them
    below its limit and shuffles them beyond it."""
    return rows.join(per_source, F.col("source").eqNullSafe(F.col("__s")), how).drop("__s")


def report(documents: DataFrame) -> DataFrame:
    return mix(documents).select("doc_id", "source", "size", "source_size", "target", "taken", "copies")


#: The same rows in DuckDB.
ORACLE = """
WITH d AS (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS w FROM s),
q AS (SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / w AS q FROM w),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER up, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER up, 0)) AS level FROM q
      WINDOW up AS (ORDER BY q, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT source, source_size, CASE WHEN level > q THEN cap ELSE (SELECT arg_min(level, q) FROM l WHERE level <= q) * w END::DOUBLE AS target FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS r FROM f),
p AS (SELECT *, floor(r + 1e-12)::BIGINT AS whole, greatest(0.0, r - floor(r + 1e-12)) AS p FROM r),
x AS (SELECT d.*, p.* EXCLUDE (source), p * source_size AS need, ((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
o AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY u, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM x WHERE p > 0),
t AS (SELECT source, min(u) AS stop, arg_min(need - upto + size, u) AS rest FROM o WHERE upto > need GROUP BY source),
g AS (SELECT o.source, arg_min(u, (abs(size - rest), u)) AS fill FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source
      WHERE u >= stop AND abs(size - rest) < rest GROUP BY o.source),
c AS (SELECT x.*, whole + CASE WHEN p > 0 AND (stop IS NULL OR u < stop OR coalesce(u = fill, false)) THEN 1 ELSE 0 END AS copies
      FROM x LEFT JOIN t ON x.source IS NOT DISTINCT FROM t.source LEFT JOIN g ON x.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, source, size, source_size, target, (size * copies)::BIGINT AS taken, copies::BIGINT AS copies FROM c
"""
