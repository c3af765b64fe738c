"""Job lifecycle: heartbeats and the dead-man rule, progress, retries; as batch queries and as streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

GRACE_S = 900.0
CONTEXT = 16384


def deadman(beats: DataFrame, now: float, grace_s: float = GRACE_S) -> DataFrame:
    """instance, last, silent_s, dead of heartbeats (instance, at): dead if silent for more than the grace."""
    last = beats.groupBy("instance").agg(F.max("at").alias("last")).withColumn("silent_s", F.lit(float(now)) - F.col("last"))
    return last.withColumn("dead", F.col("silent_s") > grace_s)


def silences(beats: DataFrame, grace_s: float = GRACE_S) -> DataFrame:
    """instance, since, until: gaps between heartbeats that are longer than the grace."""
    nxt = F.lead("at").over(Window.partitionBy("instance").orderBy("at"))
    return beats.withColumn("until", nxt).where(F.col("until") - F.col("at") > grace_s).select("instance", F.col("at").alias("since"), "until")


def silence_stream(beats: DataFrame, grace_s: float = GRACE_S, late: str = "0 seconds") -> DataFrame:
    """silences() over a stream (instance, at TIMESTAMP): the last heartbeat of an instance is its state, and an event-time
    timer tells of instances that stay silent (until is null) once the watermark passes the grace."""

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = []
        last = state.get[0] if state.exists else None
        if state.hasTimedOut:
            yield pd.DataFrame({"instance": [key[0]], "since": [last], "until": [None]}).astype({"until": "float64"})
            state.remove()
            return
        at = sorted(x for b in batches for x in (b["at"].astype("int64") / _unit(b["at"])).tolist())
        for t in at:
            if last is not None and t - last > grace_s:
                rows.append((key[0], last, t))
            last = t if last is None else max(last, t)
        state.update((last,))
        timeout = int((last + grace_s) * 1000)
        if timeout > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(timeout)
        yield pd.DataFrame(rows, columns=["instance", "since", "until"]).astype({"instance": "int64", "since": "float64", "until": "float64"})

    return (
        beats.withWatermark("at", late).groupBy("instance")
        .applyInPandasWithState(watch, "instance long, since double, until double", "last double", "append", GroupStateTimeout.EventTimeTimeout)
    )


def _unit(at: pd.Series) -> float:
    """Ticks in a second of a timestamp column."""
    return {"s": 1.0, "ms": 1e3, "us": 1e6, "ns": 1e9}[getattr(at.dt, "unit", "ns")]


def progress(done: DataFrame) -> DataFrame:
    """run, page, pages_done, seconds, pages_per_s after each finished page (run, page, at)."""
    by = Window.partitionBy("run").orderBy("at", "page")
    n = F.row_number().over(by).cast("long")
    seconds = F.col("at") - F.min("at").over(Window.partitionBy("run"))
    rows = done.withColumn("pages_done", n).withColumn("seconds", seconds)
    return rows.select("run", "page", "pages_done", "seconds", F.when(F.col("seconds") > 0, F.col("pages_done") / F.col("seconds")).alias("pages_per_s"))


def progress_stream(done: DataFrame) -> DataFrame:
    """Pages done and the time of the last one per run, kept up to date over a stream of finished pages (run, at)."""
    return done.groupBy("run").agg(F.count(F.lit(1)).alias("pages_done"), F.max("at").alias("last"))


def valid_response(finish: str = "finish_reason", total: str = "total_tokens"):
    """Whether an answer was finished and stayed within the context."""
    return F.coalesce((F.col(finish) == "stop") & (F.coalesce(total, F.lit(0)) <= CONTEXT), F.lit(False))


def retry_outcome(attempts: DataFrame, most: int = 4) -> DataFrame:
    """page, attempts, rotation, fallback, tokens of each page from its attempts in order.

    attempts: page, attempt (from 1), error, finish_reason, total_tokens, rotation_valid, rotation_wanted, in_tokens,
    out_tokens. An attempt fails by error, cut-off or length. The first otherwise good attempt that asks for a turn by a
    quarter is repeated turned; later requests are ignored. The first good attempt after that is the result; after
    `most` attempts the text layer stands in.

    Only one attempt can be spent on a turn, so the rule is: of the good attempts, the first, unless it asks for a turn,
    then the second."""
    quarter = F.col("rotation_wanted").isin(90, 180, 270) & ~F.coalesce("rotation_valid", F.lit(True))
    good = F.col("error").isNull() & valid_response()
    rows = attempts.where(F.col("attempt") <= most).withColumn("__turn", quarter)
    ranked = rows.where(good).withColumn("__n", F.row_number().over(Window.partitionBy("page").orderBy("attempt")))
    first = ranked.where("__n <= 2").groupBy("page").agg(
        F.max(F.when(F.col("__n") == 1, F.struct("attempt", "__turn", "rotation_wanted", "in_tokens", "out_tokens"))).alias("a"),
        F.max(F.when(F.col("__n") == 2, F.struct("attempt", "in_tokens", "out_tokens"))).alias("b"),
    )
    pages = attempts.select("page").distinct().join(first, "page", "left")
    turned = F.coalesce(F.col("a.__turn"), F.lit(False))
    pick = lambda c: F.when(turned, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}"))
    done = pick("attempt")
    return pages.select(
        "page", F.coalesce(done, F.lit(most)).cast("long").alias("attempts"), F.when(turned & done.isNotNull(), F.col("a.rotation_wanted")).otherwise(0).cast("int").alias("rotation"),
        done.isNull().alias("fallback"), F.coalesce(pick("in_tokens"), F.lit(0)).cast("long").alias("in_tokens"), F.coalesce(pick("out_tokens"), F.lit(0)).cast("long").alias("out_tokens"),
    )


def pending(pages: DataFrame, done: DataFrame) -> DataFrame:
    """pages that aren't done: what a resumed job still has to do."""
    return pages.join(done.select("page").distinct(), "page", "left_anti")


def run_stats(pages: DataFrame) -> DataFrame:
    """One row over page facts (attempts, fallback, in_tokens, out_tokens, seconds)."""
    n = F.count(F.lit(1))
    return pages.agg(
        n.alias("pages"), F.round(n / F.sum("seconds"), 3).alias("pages_per_s"), F.sum("in_tokens").alias("in_tokens"), F.sum("out_tokens").alias("out_tokens"),
        F.count_if("fallback").alias("fallback_pages"), F.round(F.avg("attempts"), 2).alias("avg_attempts"),
    )


def outcomes(statuses: DataFrame, timeout_s: float) -> DataFrame:
    """instance, outcome, at: the first decisive status (instance, at in seconds, status) of each instance.

    running is up, exited and offline are dead; one that isn't decided within timeout_s of its first status is late.
    One aggregation, so it serves a batch and a stream in complete mode."""
    what = F.when(F.col("status") == "running", "up").when(F.col("status").isin("exited", "offline"), "dead")
    first = F.min_by(F.struct("at", what.alias("outcome")), F.when(what.isNotNull(), F.struct("at", what)))
    rows = statuses.groupBy("instance").agg(F.min("at").alias("__since"), first.alias("__d"))
    soon = F.coalesce(F.col("__d.at") - F.col("__since") < timeout_s, F.lit(False))
    return rows.select("instance", F.when(soon, F.col("__d.outcome")).otherwise("late").alias("outcome"), F.when(soon, F.col("__d.at")).otherwise(F.col("__since") + timeout_s).alias("at"))


def overdue(ticks: DataFrame, runs: DataFrame) -> DataFrame:
    """instance, at of the ticks (instance, at) at or after the end of the run's budget (runs: instance, started, limit_s).

    Without state, so that each later tick of a stream asks again until the instance is gone and no longer ticks."""
    ends = runs.select("instance", (F.col("started") + F.col("limit_s")).alias("__end"))
    return ticks.join(ends, "instance").where(F.col("at") >= F.col("__end")).select("instance", "at")


def summary(pages: DataFrame) -> DataFrame:
    """run, pages, seconds, pages_per_sec of each run's finished pages (run, at in seconds)."""
    span = F.max("at") - F.min("at")
    return pages.groupBy("run").agg(F.count(F.lit(1)).alias("pages"), F.round(span, 1).alias("seconds"), F.round(F.count(F.lit(1)) / F.greatest(span, F.lit(1e-6)), 3).alias("pages_per_sec"))


def write_summary(rows: DataFrame, path: str) -> None:
    """Replace the summary of runs at path: a JSON line each."""
    rows.write.mode("overwrite").json(path)
