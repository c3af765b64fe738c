"""Run history: medians, preferred machines, totals, link fit, machines to avoid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _truthy(c: str):
    return F.col(c).isNotNull() & (F.col(c) != 0)


def _known(runs: DataFrame, image: str) -> DataFrame:
    return runs.where((F.col("image") == image) & _truthy("machine_id"))


_TIMED = "ok and run_s is not null and run_s <> 0 and job like 'tables%'"


def fast_machines(runs: DataFrame, bad: DataFrame, image: str) -> DataFrame:
    """machine_id, tier, measure, pos: machines by measured speed.

    Tier 0: by median run time, none slower than twice the best. Tier 1: never timed, by median download speed."""
    own = _known(runs, image).join(F.broadcast(bad.select("machine_id").distinct()), "machine_id", "left_anti")
    by = own.groupBy("machine_id").agg(
        F.median(F.when(F.expr(_TIMED), F.col("run_s"))).alias("run"), F.median(F.when(_truthy("download_mbps"), F.col("download_mbps"))).alias("probe")
    )
    best = by.agg(F.min("run").alias("best"))  # one row
    timed = by.where("run is not null").crossJoin(F.broadcast(best)).where("run <= 2 * best").select("machine_id", F.lit(0).alias("tier"), F.col("run").alias("measure"))
    probed = by.where("run is null and probe is not null").select("machine_id", F.lit(1).alias("tier"), (-F.col("probe")).alias("measure"))
    return _placed(timed.unionByName(probed), "tier", "measure", "machine_id")


def slow_machines(runs: DataFrame, bad: DataFrame, image: str) -> DataFrame:
    """Machines with timed runs that aren't among the fast ones (machines to avoid included)."""
    seen = _known(runs, image).where(_TIMED).select("machine_id").distinct()
    return seen.join(fast_machines(runs, bad, image).select("machine_id"), "machine_id", "left_anti")


def warm_machines(runs: DataFrame, image: str) -> DataFrame:
    """Machines where the image once came up, by latest start first; equal starts by first appearance."""
    warm = _known(runs, image).where("setup_s > 0").groupBy("machine_id").agg(F.max(F.coalesce("started", F.lit(0.0))).alias("latest"), F.min("seq").alias("__first"))
    return _placed(warm.withColumn("__late", -F.col("latest")), "__late", "__first").select("machine_id", "latest", "pos")


def preference_list(runs: DataFrame, bad: DataFrame, image: str) -> DataFrame:
    """machine_id, pos: fast machines, then warm ones that are neither bad, fast nor slow."""
    fast, slow = fast_machines(runs, bad, image), slow_machines(runs, bad, image)
    out = bad.select("machine_id").unionByName(fast.select("machine_id")).unionByName(slow.select("machine_id")).distinct()
    warm = warm_machines(runs, image).join(out, "machine_id", "left_anti")
    both = fast.select("machine_id", F.lit(0).alias("part"), F.col("pos").alias("at")).unionByName(warm.select("machine_id", F.lit(1).alias("part"), F.col("pos").alias("at")))
    return _placed(both, "part", "at").select("machine_id", "pos")


def _placed(rows: DataFrame, *order: str) -> DataFrame:
    """pos from 1; one row per machine, so the single task that ranks them is bounded by the number of machines."""
    return rows.withColumn("pos", F.row_number().over(Window.orderBy(*order)).cast("long"))


def totals(runs: DataFrame) -> DataFrame:
    return runs.agg(F.count(F.lit(1)).alias("n_runs"), F.count_if("ok").alias("n_ok"), F.sum(F.coalesce("cost_usd", F.lit(0.0))).alias("spent"))


def link_fit(runs: DataFrame) -> DataFrame:
    """samples, median, p25 of achieved over advertised speed: order statistics, not interpolated; none below 5 samples.

    Equal samples are counted first; the ranks then run over distinct values."""
    share = (F.col("image_gb") * F.lit(8.0) * F.lit(1024.0) / F.col("setup_s")) / F.col("inet_down_adv")
    e = runs.where("inet_down_adv <> 0 and setup_s > 0 and image_gb <> 0").select(share.alias("e"))
    at = e.groupBy("e").agg(F.count(F.lit(1)).alias("n"))
    total = e.agg(F.count(F.lit(1)).alias("samples"))
    run = Window.orderBy("e").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = at.withColumn("upto", F.sum("n").over(run)).crossJoin(F.broadcast(total))
    least = lambda i: F.min(F.when(F.col("upto") > i, F.col("e")))
    big = F.col("samples") >= 5
    return placed.groupBy("samples").agg(least(F.floor(F.col("samples") / 2)).alias("median"), least(F.floor(F.col("samples") / 4)).alias("p25")).select("samples", F.when(big, F.col("median")).alias("median"), F.when(big, F.col("p25")).alias("p25"))


def upsert_bad(known: DataFrame, news: DataFrame) -> DataFrame:
    """machine_id, reason, ts: the latest entry of each machine over both tables."""
    both = known.unionByName(news)
    return both.groupBy("machine_id").agg(F.max_by(F.struct("reason", "ts"), F.struct("ts", "seq")).alias("x")).select("machine_id", "x.reason", "x.ts")


def ledger_lines(runs: DataFrame, n: int = 10) -> DataFrame:
    """The last n runs by position with the speed at which the image came: image_gb * 8 * 1024 / setup_s."""
    speed = F.when(F.col("setup_s") > 0, F.col("image_gb") * F.lit(8.0) * F.lit(1024.0) / F.col("setup_s"))
    return runs.orderBy(F.col("seq").desc()).limit(n).select("seq", "job", "machine_id", "ok", "cost_usd", speed.alias("observed_mbps"))


def first_hole(done: DataFrame, by: str, page: str) -> DataFrame:
    """Per group the first page from 0 that isn't done, or the last done page if there is no hole.

    A page starts a hole if its rank among the distinct done pages falls behind its number."""
    ranked = done.select(by, page).distinct().withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy(page)) - 1)
    first = F.min(F.when(F.col(page) != F.col("r"), F.col("r")))
    return ranked.groupBy(by).agg(first.alias("hole"), F.max(page).alias("last")).select(by, F.coalesce("hole", "last").cast("long").alias("first_hole"))


def median_by(rows: DataFrame, by: str, value: str) -> DataFrame:
    """Exact medians, the mean of the middle two for even counts."""
    return rows.groupBy(by).agg(F.median(value).alias("median"), F.count(F.lit(1)).alias("n"))
