"""Queries over offers and run history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import costs, history
from .views import view

RUNS: dict = {}


def query(sql: str | None):
    def add(f):
        RUNS[f.__name__] = (f, sql)
        return f

    return add


_EST = """
e AS (SELECT *, greatest(coalesce(nullif(inet_down, 0e0), 100e0), 50e0) AS down, greatest(coalesce(nullif(cpu_ghz, 0e0), 5e0), 15e-1) AS ghz FROM v_offers),
f AS (SELECT *, 95e0 + 6e-2 * 8192e0 / least(down * 5e-2, 120e0) + 6e-2 * 1024e0 / 11e0 + 72e-1 * 8192e0 / (down * 85e-2) + 65e0 * 5e0 / ghz AS setup_s FROM e),
c AS (SELECT *, 45e0 * 60e0 AS compute_s, setup_s + 45e0 * 60e0 AS total_s, dph_total * (setup_s + 45e0 * 60e0) / 3600e0 AS rent_usd, (6e-2 + 72e-1) / 1024e0 * coalesce(internet_down_cost_per_tb, 0e0) AS traffic_usd FROM f),
o AS (SELECT *, rent_usd + traffic_usd AS total_usd FROM c)"""


def _offers(spark, sf_dir):
    return costs.estimate(view(spark, sf_dir, "v_offers"), 0.06, 45.0, 7.2, 65.0)


def _bad(spark, sf_dir):
    return view(spark, sf_dir, "v_runs").where("machine_id > 0").select("machine_id").where("machine_id % 10 = 7").distinct()


@query(f"WITH {_EST} SELECT id, round(setup_s, 6) AS setup_s, round(total_s, 6) AS total_s, round(rent_usd, 9) AS rent_usd, round(traffic_usd, 9) AS traffic_usd, round(total_usd, 9) AS total_usd FROM o")
def offer_total_cost(spark, sf_dir):
    e = _offers(spark, sf_dir)
    return e.select("id", F.round("setup_s", 6).alias("setup_s"), F.round("total_s", 6).alias("total_s"), F.round("rent_usd", 9).alias("rent_usd"), F.round("traffic_usd", 9).alias("traffic_usd"), F.round("total_usd", 9).alias("total_usd"))


@query(f"WITH {_EST} SELECT id, machine_id, round(total_usd, 9) AS total_usd FROM o WHERE machine_id NOT IN (SELECT machine_id FROM v_runs WHERE machine_id > 0 AND machine_id % 10 = 7) ORDER BY o.total_usd, id LIMIT 8")
def offers_ranked(spark, sf_dir):
    top = costs.cheapest(costs.without(_offers(spark, sf_dir), _bad(spark, sf_dir)), 8)
    return top.select("id", "machine_id", F.round("total_usd", 9).alias("total_usd"))


_FAST = """
bad AS (SELECT DISTINCT machine_id FROM v_runs WHERE machine_id > 0 AND machine_id % 10 = 7),
own AS (SELECT * FROM v_runs WHERE image = 'image-a' AND machine_id <> 0 AND machine_id NOT IN (SELECT machine_id FROM bad)),
m AS (SELECT machine_id, median(CASE WHEN ok AND run_s <> 0 AND job LIKE 'tables%' THEN run_s END) AS run, median(CASE WHEN download_mbps <> 0 THEN download_mbps END) AS probe FROM own GROUP BY machine_id),
u AS (SELECT machine_id, 0 AS tier, run AS measure FROM m WHERE run IS NOT NULL AND run <= 2 * (SELECT min(run) FROM m) UNION ALL SELECT machine_id, 1, -probe FROM m WHERE run IS NULL AND probe IS NOT NULL),
fast AS (SELECT machine_id, tier, measure, row_number() OVER (ORDER BY tier, measure, machine_id) AS pos FROM u),
slow AS (SELECT DISTINCT machine_id FROM v_runs WHERE image = 'image-a' AND machine_id <> 0 AND ok AND run_s <> 0 AND job LIKE 'tables%' AND machine_id NOT IN (SELECT machine_id FROM fast)),
w AS (SELECT machine_id, max(started) AS latest, min(seq) AS f FROM v_runs WHERE image = 'image-a' AND machine_id <> 0 AND setup_s > 0 GROUP BY machine_id),
warm AS (SELECT machine_id, latest, row_number() OVER (ORDER BY latest DESC, f) AS pos FROM w),
pref AS (SELECT machine_id, row_number() OVER (ORDER BY part, place) AS pos FROM (SELECT machine_id, 0 AS part, pos AS place FROM fast UNION ALL
  SELECT machine_id, 1, pos FROM warm WHERE machine_id NOT IN (SELECT machine_id FROM bad UNION SELECT machine_id FROM fast UNION SELECT machine_id FROM slow)) x)"""


@query(f"WITH {_EST}, {_FAST}, b AS (SELECT * FROM o WHERE machine_id NOT IN (SELECT machine_id FROM bad)) SELECT id, b.machine_id, round(total_usd, 9) AS total_usd FROM b LEFT JOIN pref USING (machine_id) ORDER BY pos IS NULL, pos, b.total_usd, id LIMIT 1")
def offer_pick(spark, sf_dir):
    runs, bad = view(spark, sf_dir, "v_runs"), _bad(spark, sf_dir)
    one = costs.pick(costs.without(_offers(spark, sf_dir), bad), history.preference_list(runs, bad, "image-a"))
    return one.select("id", "machine_id", F.round("total_usd", 9).alias("total_usd"))


@query("SELECT id FROM v_offers WHERE gpu_name = 'Brand#13' AND num_gpus = 2 AND rentable AND verified AND reliability > 0.95 AND dph_total < 1.2 AND inet_down > 100 AND disk_space > 60 AND disk_bw > 100 AND cuda_vers >= 12 UNION ALL SELECT id FROM v_offers WHERE machine_id = 7 AND num_gpus = 1 AND rentable AND dph_total < 0.25")
def host_filter(spark, sf_dir):
    offers = view(spark, sf_dir, "v_offers")
    wide = costs.fits(costs.Host("Brand#13", 2, 0.95, 1.2, 100.0, 60.0, 100.0, 12.0))
    pinned = costs.fits(costs.Host("Brand#13", 1, max_dph=0.25, machine_id=7))
    return offers.where(wide).select("id").unionByName(offers.where(pinned).select("id"))


@query(f"WITH {_FAST} SELECT machine_id, tier, round(measure, 6) AS measure, pos FROM fast")
def fast_machines(spark, sf_dir):
    return history.fast_machines(view(spark, sf_dir, "v_runs"), _bad(spark, sf_dir), "image-a").withColumn("measure", F.round("measure", 6))


@query(f"WITH {_FAST} SELECT machine_id FROM slow")
def slow_machines(spark, sf_dir):
    return history.slow_machines(view(spark, sf_dir, "v_runs"), _bad(spark, sf_dir), "image-a")


@query(f"WITH {_FAST} SELECT machine_id, latest, pos FROM warm")
def warm_machines(spark, sf_dir):
    return history.warm_machines(view(spark, sf_dir, "v_runs"), "image-a")


@query(f"WITH {_FAST} SELECT machine_id, pos FROM pref")
def preference_list(spark, sf_dir):
    return history.preference_list(view(spark, sf_dir, "v_runs"), _bad(spark, sf_dir), "image-a")


@query("SELECT count(*)::BIGINT AS n_runs, count(*) FILTER (ok)::BIGINT AS n_ok, round(sum(coalesce(cost_usd, 0)), 6) AS spent FROM v_runs")
def ledger_totals(spark, sf_dir):
    return history.totals(view(spark, sf_dir, "v_runs")).withColumn("spent", F.round("spent", 6))


@query("""
WITH e AS (SELECT image_gb * 8e0 * 1024e0 / setup_s / inet_down_adv AS e FROM v_runs WHERE inet_down_adv <> 0 AND setup_s > 0 AND image_gb <> 0), l AS (SELECT count(*)::BIGINT AS samples, list_sort(list(e)) AS v FROM e)
SELECT samples, round(CASE WHEN samples >= 5 THEN v[samples // 2 + 1] END, 9) AS median, round(CASE WHEN samples >= 5 THEN v[samples // 4 + 1] END, 9) AS p25 FROM l""")
def link_fit(spark, sf_dir):
    return history.link_fit(view(spark, sf_dir, "v_runs")).withColumn("median", F.round("median", 9)).withColumn("p25", F.round("p25", 9))


@query("SELECT seq, dph * (setup_s + run_s) / 3600e0 + per_tb * (image_gb + 72e-1) / 1024e0 AS cost FROM v_runs")
def run_cost(spark, sf_dir):
    return costs.run_cost(view(spark, sf_dir, "v_runs").withColumn("total_s", F.col("setup_s") + F.col("run_s")), 7.2).select("seq", "cost")


@query("SELECT seq, round(CASE WHEN dph > 0 THEN least(1e0 / dph * 3600e0, 90e0 * 60e0) ELSE 90e0 * 60e0 END, 6) AS limit_s, CASE WHEN dph > 0 AND 1e0 / dph * 3600e0 < 90e0 * 60e0 THEN 'money' ELSE 'time' END AS reason FROM v_runs")
def budget_limit(spark, sf_dir):
    return costs.budget_limit(view(spark, sf_dir, "v_runs"), 1.0, 90.0).select("seq", F.round("limit_s", 6).alias("limit_s"), "reason")


@query("""
WITH a AS (SELECT machine_id, job AS reason, started AS ts, seq FROM v_runs WHERE NOT ok AND machine_id <> 0)
SELECT machine_id, arg_max(reason, ts) AS reason, max(ts) AS ts FROM a GROUP BY machine_id""")
def bad_machine_upsert(spark, sf_dir):
    failed = view(spark, sf_dir, "v_runs").where("not ok and machine_id <> 0").select("machine_id", F.col("job").alias("reason"), F.col("started").alias("ts"), "seq")
    return history.upsert_bad(failed.where("seq % 2 = 0"), failed.where("seq % 2 = 1"))


@query("SELECT machine_id, round(median(run_s), 6) AS median, count(*)::BIGINT AS n FROM v_runs WHERE run_s > 0 GROUP BY machine_id")
def machine_medians(spark, sf_dir):
    return history.median_by(view(spark, sf_dir, "v_runs").where("run_s > 0"), "machine_id", "run_s").withColumn("median", F.round("median", 6))


@query("SELECT seq, job, machine_id, ok, round(cost_usd, 9) AS cost_usd, round(CASE WHEN setup_s > 0 THEN image_gb * 8e0 * 1024e0 / setup_s END, 6) AS observed_mbps FROM v_runs ORDER BY seq DESC LIMIT 10")
def ledger_lines(spark, sf_dir):
    return history.ledger_lines(view(spark, sf_dir, "v_runs")).withColumn("cost_usd", F.round("cost_usd", 9)).withColumn("observed_mbps", F.round("observed_mbps", 6))


@query("""
WITH d AS (SELECT DISTINCT user_id AS run, event_id % 40 AS page FROM events WHERE event_id % 40 < 25), r AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY page) - 1 AS r FROM d)
SELECT run, coalesce(min(r) FILTER (page <> r), max(page))::BIGINT AS first_hole FROM r GROUP BY run""")
def first_hole(spark, sf_dir):
    done = view(spark, sf_dir, "events").where("event_id % 40 < 25").select(F.col("user_id").alias("run"), (F.col("event_id") % 40).alias("page"))
    return history.first_hole(done, "run", "page")


@query("SELECT id, concat(num_gpus, ' x ', gpu_name, ', down ', coalesce(inet_down, 0)::BIGINT, ' Mbit/s, disk ', coalesce(disk_bw, 0)::BIGINT, ' MB/s, ', printf('%.1f', coalesce(cpu_ghz, 0)), ' GHz x ', coalesce(cpu_cores_effective, 0)::BIGINT) AS line FROM v_offers")
def offer_lines(spark, sf_dir):
    return costs.description(view(spark, sf_dir, "v_offers")).select("id", "line")


@query("SELECT seq, coalesce(setup_s >= CASE WHEN coalesce(download_mbps, 0) > 0 THEN least(2e0, 5e-1 * download_mbps) ELSE 2e0 END AND run_s >= 0, false) AS accepted FROM v_runs")
def link_acceptance(spark, sf_dir):
    rows = view(spark, sf_dir, "v_runs").select("seq", F.col("setup_s").alias("link"), F.col("run_s").alias("down"), F.col("download_mbps").alias("own"))
    return costs.accepted_links(rows).select("seq", F.coalesce("accepted", F.lit(False)).alias("accepted"))
