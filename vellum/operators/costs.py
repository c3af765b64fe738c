"""Offers: host filter, whole-run cost, choice; budgets and run costs.

A zero counts as missing wherever a default exists, as it does in offers that machines fill in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def default(c: str, value: float) -> Column:
    return F.coalesce(F.nullif(F.col(c), F.lit(0.0)), F.lit(float(value)))


@dataclass(frozen=True)
class Model:
    """Constants of the cost model (fixed values): how links, unpacking, boot and warm-up scale."""

    docker_share: float = 0.05
    docker_ceiling: float = 120.0
    unpack_mb_s: float = 11.0
    payload_share: float = 0.85
    boot_s: float = 95.0
    warm_ghz: float = 5.0
    least_ghz: float = 1.5
    usual_down: float = 100.0
    least_down: float = 50.0


@dataclass(frozen=True)
class Host:
    """Wanted host. A pinned machine keeps only the machine, card count, rentability and price cap."""

    gpu: str
    num_gpus: int = 1
    min_reliability: float = 0.98
    max_dph: float = 0.4
    min_down: float = 500.0
    disk_gb: float = 60.0
    min_disk_bw: float = 500.0
    cuda: float = 12.0
    machine_id: int | None = None
    region: str | None = None


def estimate(offers: DataFrame, image_gb: float, minutes: float, payload_gb: float = 0.0, warmup_s: float = 0.0, m: Model = Model()) -> DataFrame:
    """offers with setup_s, compute_s, total_s, rent_usd, traffic_usd, total_usd."""
    down = F.greatest(default("inet_down", m.usual_down), F.lit(m.least_down))
    image = F.lit(image_gb * 8192.0) / F.least(down * F.lit(m.docker_share), F.lit(m.docker_ceiling)) + F.lit(image_gb * 1024.0 / m.unpack_mb_s)
    payload = F.lit(payload_gb * 8192.0) / (down * F.lit(m.payload_share))
    warm = F.lit(warmup_s * m.warm_ghz) / F.greatest(default("cpu_ghz", m.warm_ghz), F.lit(m.least_ghz))
    out = offers.withColumn("setup_s", F.lit(m.boot_s) + image + payload + warm).withColumn("compute_s", F.lit(minutes * 60.0)).withColumn("total_s", F.col("setup_s") + F.col("compute_s"))
    out = out.withColumn("rent_usd", F.col("dph_total") * F.col("total_s") / F.lit(3600.0)).withColumn("traffic_usd", F.lit((image_gb + payload_gb) / 1024.0) * F.coalesce("internet_down_cost_per_tb", F.lit(0.0)))
    return out.withColumn("total_usd", F.col("rent_usd") + F.col("traffic_usd"))


def fits(host: Host) -> Column:
    """The predicate of a wanted host; it reaches the scan as pushed filters."""
    if host.machine_id:
        want = (F.col("machine_id") == host.machine_id) & (F.col("num_gpus") == host.num_gpus) & F.col("rentable") & (F.col("dph_total") < host.max_dph)
    else:
        want = (
            (F.col("gpu_name") == host.gpu) & (F.col("num_gpus") == host.num_gpus) & F.col("rentable") & F.col("verified") & (F.col("reliability") > host.min_reliability)
            & (F.col("dph_total") < host.max_dph) & (F.col("inet_down") > host.min_down) & (F.col("disk_space") > host.disk_gb) & (F.col("disk_bw") > host.min_disk_bw) & (F.col("cuda_vers") >= host.cuda)
        )
    return want & (F.col("region") == host.region) if host.region else want


def market(offers: DataFrame, host: Host) -> DataFrame:
    """The offers that fit, by price; ValueError where there is none."""
    found = offers.where(fits(host))
    if found.isEmpty():
        raise ValueError(f"no offer fits {host}")
    return found.orderBy("dph_total", "id")


def without(offers: DataFrame, avoid: DataFrame) -> DataFrame:
    """offers whose machine isn't in avoid (machine_id); offers without a machine stay."""
    return offers.join(avoid.select("machine_id").distinct(), "machine_id", "left_anti")


def cheapest(offers: DataFrame, k: int) -> DataFrame:
    """The k offers of least total cost; equal costs in order of id."""
    return offers.orderBy("total_usd", "id").limit(k)


def pick(offers: DataFrame, preference: DataFrame) -> DataFrame:
    """One offer: the cheapest of the first preferred machine (pos, machine_id) that has one, else the cheapest.

    min_by keeps one row per machine with partial aggregation; there is no sort of all offers."""
    best = offers.groupBy("machine_id").agg(F.min_by(F.struct("id", "total_usd"), F.struct("total_usd", "id")).alias("o"))
    ranked = best.join(preference, "machine_id", "left").select(F.struct(F.col("pos").isNull(), "pos", "o.total_usd", "o.id").alias("rank"), "machine_id", "o")
    return ranked.agg(F.min_by(F.struct("machine_id", "o.id", "o.total_usd"), "rank").alias("x")).select("x.id", "x.machine_id", "x.total_usd").where("id is not null")


def budget_limit(rows: DataFrame, budget_usd: float, timeout_min: float) -> DataFrame:
    """rows (dph) with limit_s, and which limit it is."""
    money = F.lit(budget_usd) / F.col("dph") * F.lit(3600.0)
    time = F.lit(timeout_min * 60.0)
    return rows.withColumn("limit_s", F.when(F.col("dph") > 0, F.least(money, time)).otherwise(time)).withColumn("reason", F.when((F.col("dph") > 0) & (money < time), "money").otherwise("time"))


def run_cost(rows: DataFrame, payload_gb: float) -> DataFrame:
    """rows (dph, total_s, per_tb, image_gb) with cost: rent for the time and traffic for image and payload."""
    return rows.withColumn("cost", F.col("dph") * F.col("total_s") / F.lit(3600.0) + F.col("per_tb") * (F.col("image_gb") + F.lit(payload_gb)) / F.lit(1024.0))


def description(offers: DataFrame) -> DataFrame:
    """offers with a line that describes each machine; missing numbers read 0."""
    n = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return offers.withColumn("line", F.format_string("%d x %s, down %.0f Mbit/s, disk %.0f MB/s, %.1f GHz x %.0f", "num_gpus", "gpu_name", n("inet_down"), n("disk_bw"), n("cpu_ghz"), n("cpu_cores_effective")))


def accepted_links(rows: DataFrame) -> DataFrame:
    """rows (link, down, own) with accepted: the link is at least 2 Mbit/s, or half of our own where that is less."""
    need = F.when(F.coalesce("own", F.lit(0.0)) > 0, F.least(F.lit(2.0), F.lit(0.5) * F.col("own"))).otherwise(F.lit(2.0))
    return rows.withColumn("accepted", (F.col("link") >= need) & (F.col("down") >= 0))


