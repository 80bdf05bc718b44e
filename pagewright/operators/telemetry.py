"""Costs, throughput, call health, retries and resource series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import CALLS, calls, running, table

# Price per thousand tokens, the estimate of a page's input, failures that open a circuit and for how long.
PRICE_PER_1K = 0.02
PAGE_TOKENS = 1500
OPEN_AFTER, OPEN_SECONDS = 5, 300
BASE_DELAY, MAX_DELAY, LEAST_DELAY = 1.0, 30.0, 0.1
RETRY_STATUS = (429, 500, 502, 503, 504)
SKIP_PATTERNS = ["DataInspectionFailed", "inappropriate content", "InvalidParameter", "InvalidAPIKey"]
RETRY_PATTERNS = ["NoneType", "TimeoutError", "ConnectionError", "SSLError", "502", "503", "504", "UNEXPECTED_EOF", "Rate limit"]


def cost(input_tokens: Column, output_tokens: Column, price: float = PRICE_PER_1K) -> Column:
    """Both kinds of tokens at the same price, four decimals; tokens add up as whole numbers first."""
    return F.round((input_tokens + output_tokens) * price / 1000, 4)


def ratios(tokens: Column, pages: Column, total: Column) -> dict[str, Column]:
    n = F.greatest(pages, F.lit(1))
    return {"cost_per_page": F.round(total / n, 4), "tokens_per_page": F.round(tokens / n, 0)}


def token_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's tokens (a page's estimate each, a quarter of its characters back) and cost."""
    docs = table(spark, sf_dir, "documents")
    pages = F.size(F.split("text", "\n", -1)).cast("long")
    out = docs.select("doc_id", "source", pages.alias("pages"), (pages * PAGE_TOKENS).alias("input_tokens"), F.floor(F.length("text") / 4).cast("long").alias("output_tokens"))
    return out.withColumn("total_cost", cost(F.col("input_tokens"), F.col("output_tokens")))


def cost_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_cost(spark, sf_dir).groupBy("source").agg(*[F.sum(c).alias(c) for c in ("pages", "input_tokens", "output_tokens")], F.count("*").alias("docs"))
    out = out.withColumn("total_cost", cost(F.col("input_tokens"), F.col("output_tokens")))
    return out.withColumns(ratios(F.col("input_tokens") + F.col("output_tokens"), F.col("pages"), F.col("total_cost")))


def call_success_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Success rate and mean latency of the successes, by key."""
    c = calls(table(spark, sf_dir, "events")).groupBy("key")
    micros = F.round(F.col("latency") * 1000000).cast("long")
    out = c.agg(F.count("*").alias("calls"), F.count_if("ok").alias("successes"), F.sum(F.when(F.col("ok"), micros)).alias("micros"))
    out = out.withColumns({"success_rate": F.round(F.col("successes") / F.col("calls"), 4), "avg_latency": F.round(F.col("micros") / F.col("successes") / 1000000, 4)})
    return out.drop("micros")


def streaks(c: DataFrame) -> DataFrame:
    """Runs of consecutive failures by key: key, first event, length and whether they open the circuit."""
    order = Window.partitionBy("key").orderBy("ts", "event_id")
    run = F.row_number().over(order) - F.row_number().over(Window.partitionBy("key", "ok").orderBy("ts", "event_id"))
    runs = c.withColumn("run", run).where(~F.col("ok")).groupBy("key", "run")
    out = runs.agg(F.count("*").alias("length"), F.min("event_id").alias("first_event"), F.max("ts").alias("ended"))
    return out.withColumns({"opens": F.col("length") >= OPEN_AFTER, "ended": F.col("ended").cast("string")}).drop("run")


def failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaks(calls(table(spark, sf_dir, "events"))).drop("ended")


def key_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By day, the key to call next: the highest success rate, then the fewest failures, then the lowest key."""
    c = calls(table(spark, sf_dir, "events")).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "key")
    c = c.agg(F.count("*").alias("calls"), F.count_if("ok").alias("good"))
    rank = F.struct(F.round(F.col("good") / F.col("calls"), 4), F.col("good") - F.col("calls"), -F.col("key"))
    return c.groupBy("day").agg(F.max_by("key", rank).alias("key"), F.max_by("calls", rank).alias("calls"), F.max_by(F.round(F.col("good") / F.col("calls"), 4), rank).alias("success_rate"))


def delay(attempt: Column) -> Column:
    """Exponential backoff without jitter."""
    return F.greatest(F.least(BASE_DELAY * F.pow(F.lit(2.0), attempt), F.lit(MAX_DELAY)), F.lit(LEAST_DELAY))


def backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wait before each attempt: an event's attempt is its place in its key's day."""
    order = Window.partitionBy("key", F.to_date("ts")).orderBy("ts", "event_id")
    c = calls(table(spark, sf_dir, "events")).withColumn("attempt", (F.row_number().over(order) - 1).cast("long"))
    c = c.groupBy("attempt").agg(F.count("*").alias("calls"))
    return c.withColumn("delay", delay(F.least("attempt", F.lit(20))))


def category(status: Column, code: Column, exception: Column, message: Column) -> Column:
    """A failed call's kind; the first rule that fits."""
    text = F.concat_ws(" ", message, code)
    low = F.lower(exception)
    return (
        F.when(low.contains("timeout"), "timeout")
        .when(low.rlike("connection|socket"), "network")
        .when((status == 429) | F.startswith(code, F.lit("Throttling")), "throttle")
        .when(text.contains("DataInspectionFailed"), "moderation")
        .when(status >= 500, "server_error")
        .when(status.isin(401, 403), "auth")
        .when(status == 400, "bad_request")
        .when(exception.isNotNull(), "exception")
        .otherwise("other")
    )


def should_retry(status: Column, attempt: Column, most: int = 3) -> Column:
    """Whether a call is made again: for what may pass, as often as `most`."""
    return F.coalesce(status.isin(*RETRY_STATUS), F.lit(False)) & (attempt < most)


def retry_reason(message: Column) -> Column:
    """`skip: pattern` or `retry: pattern` for the first pattern a message holds; unknown errors are retried."""
    low, out = F.lower(message), None
    for kind, patterns in (("skip", SKIP_PATTERNS), ("retry", RETRY_PATTERNS)):
        for p in patterns:
            test = F.contains(low, F.lit(p.lower())), F.lit(f"{kind}: {p}")
            out = F.when(*test) if out is None else out.when(*test)
    return out.otherwise(F.lit("retry: unknown"))


def error_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as status codes and messages, by the kind of failure and what to do about it."""
    e = table(spark, sf_dir, "events")
    n = F.pmod(F.col("event_id"), F.lit(13))
    status = F.element_at(F.array(*map(F.lit, (200, 429, 500, 503, 401, 403, 400, 404, 502, 504, 200, 200, 200))), (n + 1).cast("int"))
    exception = F.when(n == 10, "ReadTimeout").when(n == 11, "ConnectionError: reset").when(n == 12, "ValueError")
    message = F.when(n == 7, "DataInspectionFailed: page").when(n == 11, "ConnectionError: reset").when(n == 8, "HTTP 502").otherwise(F.col("event_type"))
    code = F.when(n == 9, "Throttling.RateQuota").otherwise("")
    again = should_retry(status, F.pmod(F.col("event_id"), F.lit(5)))
    return e.groupBy(category(status, code, exception, message).alias("category"), retry_reason(message).alias("action")).agg(F.count("*").alias("calls"), F.count_if(again).alias("retried"))


def throughput_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = calls(table(spark, sf_dir, "events")).groupBy(F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type")
    out = c.agg(F.count("*").alias("pages"), F.countDistinct("key").alias("keys"))
    return out.withColumn("pages_per_minute", F.round(F.col("pages") / 60, 4))


def running_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The peak so far and the change by second since the last sample, by key."""
    order = Window.partitionBy("key").orderBy("ts", "event_id")
    c = calls(table(spark, sf_dir, "events"))
    micros = F.unix_micros("ts")
    seconds = (micros - F.lag(micros).over(order)) / 1000000
    rate = F.when(seconds > 0, F.round((F.col("latency") - F.lag("latency").over(order)) / seconds, 4) + F.lit(0.0))
    return c.select("event_id", "key", F.max("latency").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("peak"), rate.alias("rate"))


def resource_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By key: samples, mean, peak, the last value and how long; alerts at 80 and 95 % of the overall range."""
    c = calls(table(spark, sf_dir, "events")).groupBy("key")
    micros = F.round(F.col("latency") * 1000000).cast("long")
    out = c.agg(
        F.count("*").alias("samples"), F.round(F.sum(micros) / F.count("*") / 1000000, 4).alias("mean"), F.max("latency").alias("peak"), F.max_by("latency", F.struct("ts", "event_id")).alias("last"),
        F.floor((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1000000).cast("long").alias("seconds"), F.count_if(F.col("latency") >= 80).alias("warnings"), F.count_if(F.col("latency") >= 95).alias("alerts"),
    )
    return out


def downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most about 100 evenly spaced samples of each event type."""
    c = calls(table(spark, sf_dir, "events")).withColumns({"micros": F.unix_micros("ts"), "one": F.lit(1)})
    total = c.groupBy("event_type").agg(F.count("*").alias("n"))
    # Runs of an hour.
    c = running(c, "event_type", F.col("micros"), ["ts", "event_id"], "one", 3_600_000_000).join(total, "event_type")
    at, step = F.col("number") - 1, F.greatest(F.floor(F.col("n") / 100), F.lit(1))
    return c.where((at % step == 0) & (at / step < 100)).select("event_type", "event_id", "latency")


def recent_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each key's last ten failures."""
    last = Window.partitionBy("key").orderBy(F.desc("ts"), F.desc("event_id"))
    c = calls(table(spark, sf_dir, "events")).where(~F.col("ok"))
    return c.withColumn("rank", F.row_number().over(last).cast("long")).where("rank <= 10").select("key", "rank", "event_id", "latency")


_PATTERNS = " ".join(f"WHEN contains(lower(message), '{p.lower()}') THEN '{k}: {p}'" for k, ps in (("skip", SKIP_PATTERNS), ("retry", RETRY_PATTERNS)) for p in ps)

QUERIES = {f.__name__: f for f in (token_cost, cost_per_group, call_success_stats, failure_streaks, key_choice, backoff_schedule, error_category, throughput_per_hour, running_peaks, resource_summary, downsample, recent_warnings)}
_COST = f"SELECT doc_id, source, CAST(len(string_split(text, chr(10))) AS BIGINT) AS pages, CAST(len(string_split(text, chr(10))) AS BIGINT) * {PAGE_TOKENS} AS input_tokens, CAST(length(text) // 4 AS BIGINT) AS output_tokens FROM documents"
ORACLES = {
    "token_cost": f"SELECT *, round((input_tokens + output_tokens) * {PRICE_PER_1K}::DOUBLE / 1000, 4) AS total_cost FROM ({_COST})",
    "cost_per_group": f"""SELECT *, round(total_cost / greatest(pages, 1), 4) AS cost_per_page, round((input_tokens + output_tokens)::DOUBLE / greatest(pages, 1), 0) AS tokens_per_page FROM (
        SELECT source, CAST(sum(pages) AS BIGINT) AS pages, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, count(*) AS docs,
        round(CAST(sum(input_tokens) + sum(output_tokens) AS BIGINT) * {PRICE_PER_1K}::DOUBLE / 1000, 4) AS total_cost FROM ({_COST}) GROUP BY source)""",
    "call_success_stats": f"""SELECT key, count(*) AS calls, count(*) FILTER (ok) AS successes, round(count(*) FILTER (ok)::DOUBLE / count(*), 4) AS success_rate,
        round(CAST(sum(CAST(round(latency * 1000000) AS BIGINT)) FILTER (ok) AS DOUBLE) / count(*) FILTER (ok) / 1000000, 4) AS avg_latency FROM {CALLS} GROUP BY key""",
    "failure_streaks": f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, event_id) - row_number() OVER (PARTITION BY key, ok ORDER BY ts, event_id) AS run FROM {CALLS})
        SELECT key, count(*) AS length, min(event_id) AS first_event, count(*) >= {OPEN_AFTER} AS opens FROM r WHERE NOT ok GROUP BY key, run""",
    "key_choice": f"""WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS day, key, count(*) AS calls, count(*) FILTER (ok) AS good FROM {CALLS} GROUP BY 1, 2),
        r AS (SELECT *, round(good::DOUBLE / calls, 4) AS success_rate, row_number() OVER (PARTITION BY day ORDER BY round(good::DOUBLE / calls, 4) DESC, calls - good, key) AS n FROM d) SELECT day, key, calls, success_rate FROM r WHERE n = 1""",
    "backoff_schedule": f"""WITH a AS (SELECT row_number() OVER (PARTITION BY key, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS attempt FROM {CALLS})
        SELECT attempt, count(*) AS calls, greatest(least({BASE_DELAY}::DOUBLE * pow(2.0::DOUBLE, least(attempt, 20)), {MAX_DELAY}::DOUBLE), {LEAST_DELAY}::DOUBLE) AS delay FROM a GROUP BY attempt""",
    "error_category": f"""WITH e AS (SELECT event_id, event_type, event_id % 13 AS n, [200, 429, 500, 503, 401, 403, 400, 404, 502, 504, 200, 200, 200][event_id % 13 + 1] AS status FROM events),
        m AS (SELECT *, status IN (429, 500, 502, 503, 504) AND event_id % 5 < 3 AS again, CASE n WHEN 10 THEN 'ReadTimeout' WHEN 11 THEN 'ConnectionError: reset' WHEN 12 THEN 'ValueError' END AS exception,
            CASE n WHEN 7 THEN 'DataInspectionFailed: page' WHEN 11 THEN 'ConnectionError: reset' WHEN 8 THEN 'HTTP 502' ELSE event_type END AS message FROM e)
        SELECT CASE WHEN contains(lower(exception), 'timeout') THEN 'timeout' WHEN regexp_matches(lower(exception), 'connection|socket') THEN 'network' WHEN status = 429 OR n = 9 THEN 'throttle'
            WHEN contains(message, 'DataInspectionFailed') THEN 'moderation' WHEN status >= 500 THEN 'server_error' WHEN status IN (401, 403) THEN 'auth' WHEN status = 400 THEN 'bad_request'
            WHEN exception IS NOT NULL THEN 'exception' ELSE 'other' END AS category, CASE {_PATTERNS} ELSE 'retry: unknown' END AS action, count(*) AS calls, count(*) FILTER (again) AS retried FROM m GROUP BY 1, 2""",
    "throughput_per_hour": f"SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, event_type, count(*) AS pages, count(DISTINCT key) AS keys, round(count(*)::DOUBLE / 60, 4) AS pages_per_minute FROM {CALLS} GROUP BY 1, 2",
    "running_peaks": f"""WITH s AS (SELECT event_id, key, latency, max(latency) OVER w AS peak, lag(latency) OVER w AS before, (epoch_us(ts) - lag(epoch_us(ts)) OVER w)::DOUBLE / 1000000 AS seconds
        FROM {CALLS} WINDOW w AS (PARTITION BY key ORDER BY ts, event_id)) SELECT event_id, key, peak, CASE WHEN seconds > 0 THEN round((latency - before) / seconds, 4) + 0.0::DOUBLE END AS rate FROM s""",
    "resource_summary": f"""SELECT key, count(*) AS samples, round(CAST(sum(CAST(round(latency * 1000000) AS BIGINT)) AS DOUBLE) / count(*) / 1000000, 4) AS mean, max(latency) AS peak, arg_max(latency, (ts, event_id)) AS last,
        CAST((epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS BIGINT) AS seconds, count(*) FILTER (latency >= 80) AS warnings, count(*) FILTER (latency >= 95) AS alerts FROM {CALLS} GROUP BY key""",
    "downsample": f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS place, count(*) OVER (PARTITION BY event_type) AS n FROM {CALLS})
        SELECT event_type, event_id, latency FROM s WHERE place % greatest(n // 100, 1) = 0 AND place / greatest(n // 100, 1) < 100""",
    "recent_warnings": f"SELECT key, rank, event_id, latency FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) AS rank FROM {CALLS} WHERE NOT ok) WHERE rank <= 10",
}
