"""An append-only event ledger: entries, summaries, the tail, outages, failure runs, cooldowns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ladders import failure_kind, first_of, retryable
from tessera.functions.text import redact

FIELDS = ("ts", "phase", "batch_id", "provider", "model", "kind", "http_status", "attempt", "message", "retryable", "item_ids", "scope", "task")


def entries(raw: DataFrame, most_items: int = 50) -> DataFrame:
    """Rows with the ledger's fields: kind and retryable derived, message redacted, ids capped as an entry's own list is."""
    kind = failure_kind(F.col("http_status"), F.col("message"), F.col("kind"))
    out = raw.withColumn("kind", kind).withColumns({
        "retryable": retryable(kind, F.col("http_status"), F.col("message")), "message": redact(F.col("message")),
        "item_ids": F.slice(F.coalesce("item_ids", F.array().cast("array<string>")), 1, most_items),
    })
    return out.select(*FIELDS)


def summary(rows: DataFrame, group: Sequence[str], ts: str, seq: str, retry: Column, message: str, status: str) -> DataFrame:
    """For each group: count, first and last time, retryable ones, the last message that is not empty with its status."""
    told = F.col(message).isNotNull() & (F.col(message) != "")
    out = rows.groupBy(*group).agg(
        F.count("*").alias("count"), F.min_by(ts, seq).alias("first_ts"), F.max_by(ts, seq).alias("last_ts"), F.count_if(retry).alias("retryable"),
        F.max(F.when(told, F.struct(F.col(seq).alias("s"), F.col(message).alias("m"), F.col(status).alias("h")))).alias("__l"),
    )
    return out.withColumns({"message": F.coalesce("__l.m", F.lit("")), "http_status": F.col("__l.h")}).drop("__l")


def tail(rows: DataFrame, ts: str, seconds: int, least: int = 60) -> DataFrame:
    """Rows no older than so many seconds before the newest. The newest is one row, found first, so no window holds all."""
    newest = rows.agg(F.max(ts).alias("__newest"))
    return rows.join(F.broadcast(newest), F.col(ts) >= F.col("__newest") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(max(least, seconds)))).drop("__newest")


#: The verdicts on an outage, and what messages show it by.
NO_KEYS, NO_ROUTE, WAF, REJECTED = "no_keys_configured", "no_route_for_model", "all_providers_403_waf", "all_providers_auth_rejected"
EXHAUSTED, LIMITED, TRANSPORT, UNKNOWN = "all_keys_exhausted", "all_providers_rate_limited", "all_providers_transport_error", "unclassified_ai_outage"
WALL, SPENT, SKIPPED = "<html|cloudflare|captcha", "all keys|exhausted|no usable key", "no healthy route"


def outage(recent: DataFrame, keys_configured: bool = True, wall: str = WALL, spent: str = SPENT) -> DataFrame:
    """One row reason, rows: a verdict over a tail (kind, scope, message). Route rows are the evidence, else batch rows."""
    r = recent.select(F.coalesce("kind", F.lit("other")).alias("kind"), F.coalesce("scope", F.lit("route")).alias("scope"), F.lower(F.coalesce("message", F.lit(""))).alias("m"))
    route, batch = F.col("scope") == "route", F.col("scope") == "batch"
    a = r.agg(
        F.count("*").alias("rows"), F.count_if(route).alias("routes"), F.count_if(batch).alias("batches"),
        *(f(F.when(c, F.col(col))).alias(f"{k}_{name}") for k, c in (("r", route), ("b", batch)) for name, f, col in (("kinds", F.collect_set, "kind"),)),
        *(F.coalesce(F.max(F.when(c, F.col("m").rlike(p))), F.lit(False)).alias(f"{k}_{name}") for k, c in (("r", route), ("b", batch)) for name, p in (("wall", wall), ("spent", spent), ("skipped", SKIPPED))),
    )
    pick = lambda name: F.when(F.col("routes") > 0, F.col(f"r_{name}")).otherwise(F.col(f"b_{name}"))
    kinds = pick("kinds")
    only = lambda *k: F.size(F.array_except(kinds, F.array(*(F.lit(x) for x in k)))) == 0
    reason = first_of(
        [
            (F.lit(not keys_configured), NO_KEYS), (F.col("routes") + F.col("batches") == 0, UNKNOWN),
            ((F.col("routes") == 0) & F.col("b_skipped"), NO_ROUTE), (pick("wall") & only("auth", "http"), WAF),
            (only("auth"), REJECTED), (pick("spent") & F.array_contains(kinds, "rate_limit"), EXHAUSTED),
            (only("rate_limit"), LIMITED), (only("transport"), TRANSPORT),
            (F.col("r_skipped") | F.col("b_skipped"), NO_ROUTE),
        ],
        UNKNOWN,
    )
    return a.select(reason.alias("reason"), "rows", "routes", "batches")


def failure_runs(rows: DataFrame, group: Sequence[str], order: Sequence[str], failed: Column, halt: int) -> DataFrame:
    """rows with run (consecutive failures up to here, 0 after a success) and halted (a run reached the limit before or here)."""
    w = Window.partitionBy(*group).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    f = failed.cast("int")
    island = F.sum(F.when(failed, 0).otherwise(1)).over(upto)
    cut = rows.withColumns({"__f": f, "__i": island})
    run = F.sum("__f").over(Window.partitionBy(*group, "__i").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    out = cut.withColumn("run", F.when(F.col("__f") == 1, run).otherwise(0))
    return out.withColumn("halted", F.max(F.col("run") >= halt).over(upto)).drop("__f", "__i")


def cooldown(trips: Column, base: float, most: float) -> Column:
    """Doubled with each trip, up to a limit."""
    return F.when(trips < 1, F.lit(0.0)).otherwise(F.least(F.lit(float(most)), base * F.pow(F.lit(2.0), trips - 1)))


def progress(done: DataFrame, total: int, elapsed: float, over: bool = False) -> DataFrame:
    """One row: items done, remaining, failed, corrected, share, and the seconds left at the pace so far. over: with more done
    than the total, remaining and the seconds go below 0; else they end there."""
    n = done.agg(F.count("*").alias("done"), F.count_if("failed").alias("failed"), F.count_if("corrected").alias("corrected"))
    left = F.lit(total) - F.col("done")
    left = left if over else F.greatest(left, F.lit(0))
    return n.withColumns({"remaining": left, "share": F.round(100.0 * F.col("done") / max(total, 1), 1), "eta_seconds": F.when(F.col("done") > 0, F.round(elapsed / F.col("done") * left, 1))})
