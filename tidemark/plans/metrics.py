"""Metric panels and alerts, evaluated over the whole time span of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators import timeseries as M
from tidemark.plans import metric_data as D
from tidemark.plans.catalog import query
from tidemark.plans.metric_data import DAY, Family
from tidemark.sources.readers import parse_metric_lines
from tidemark.sources.tables import Tables

HALF = DAY // 2
QUARTER = DAY // 4
WEEK = 7 * DAY
MONTH = 30 * DAY
#: Sums of whole numbers divided by these ranges end within seven digits, so none is a tie.
DIGITS = 8


def shown(vector: DataFrame, labels: list[str]) -> DataFrame:
    value = F.when(~F.isnan("value"), F.round("value", DIGITS))
    return vector.select(*labels, F.unix_seconds("at").alias("at_epoch"), value.alias("value"))


def labelled(vector: DataFrame, labels: list[str]) -> DataFrame:
    columns = [F.col("labels")[name].alias(name) for name in labels]
    return vector.select(*columns, "at", "value")


def _sum_sql(family: Family, seconds: int, step: int, labels: list[str], kind: str, where="true"):
    """SQL of ``sum by (labels) (kind(family{where}[seconds]))``."""
    keys = ", ".join([*labels, "at_epoch"])
    base = family.sql_instant if kind == "instant" else family.sql_increase
    scale = f" / {seconds}.0" if kind == "rate" else ""
    return (
        f"WITH {base(seconds, step)} SELECT {keys}, round(sum(v){scale}, {DIGITS}) AS value"
        f" FROM i WHERE {where} GROUP BY {keys}"
    )


def sum_panel(
    name: str,
    family: Family,
    labels: list[str],
    kind: str,
    seconds: int,
    step: int,
    where: str = "true",
    **conditions: str,
) -> None:
    """Register ``sum by (labels) (kind(family{conditions}[seconds]))``."""

    def build(t: Tables) -> DataFrame:
        samples = M.matching(family.samples(t), family.metric, **conditions)
        if kind == "instant":
            return shown(M.sum_by(M.instant(samples, step=step, lookback=seconds), labels), labels)
        grown = M.sum_by(M.increase(samples, seconds, step=step), labels)
        return shown(M.per_second(grown, seconds) if kind == "rate" else grown, labels)

    query(name, _sum_sql(family, seconds, step, labels, kind, where))(build)


sum_panel(
    "panel_cpu", D.CPU, ["namespace", "pod"], "rate", DAY, HALF,
    "container <> '' AND image <> ''", container="!=", image="!=",
)
sum_panel(
    "panel_memory", D.MEMORY, ["namespace", "pod"], "instant", QUARTER, QUARTER,
    "container <> '' AND image <> ''", container="!=", image="!=",
)
sum_panel("panel_restarts", D.RESTARTS, ["namespace", "pod", "container"], "increase", DAY, HALF)
sum_panel(
    "panel_pod_phase", D.POD_PHASE, ["namespace", "pod", "phase"], "instant", QUARTER, QUARTER,
    "phase <> 'Running'", phase="!=Running",
)
sum_panel("panel_rps", D.HTTP, ["service"], "rate", DAY, HALF)
sum_panel(
    "panel_4xx", D.HTTP, ["service", "route", "status"], "rate", WEEK, DAY,
    "status LIKE '4__'", status="=~4..",
)
sum_panel("panel_job_runs", D.JOB_RUNS, ["job_name", "status"], "increase", WEEK, WEEK)
sum_panel(
    "panel_job_failed_runs", D.JOB_RUNS, ["job_name"], "increase", WEEK, WEEK,
    "status = 'failed'", status="=failed",
)
sum_panel(
    "panel_failed_tasks", D.FAILED_TASKS, ["app_name", "stage_id", "reason"], "increase",
    WEEK, WEEK,
)
sum_panel("panel_exec_memory", D.EXECUTOR_MEMORY, ["app_name"], "instant", WEEK, WEEK)
sum_panel("panel_uploads", D.UPLOADS, [], "increase", DAY, HALF)
sum_panel(
    "panel_processed", D.PROCESSED, [], "increase", DAY, HALF, "status = 'success'",
    status="=success",
)
sum_panel(
    "panel_queue_lag", D.QUEUE_LAG, ["queue", "consumer_group"], "instant", QUARTER, QUARTER
)
sum_panel("prom_sum_by", D.HTTP, ["status"], "increase", DAY, DAY)
sum_panel(
    "prom_matchers", D.HTTP, ["service", "route", "status"], "increase", WEEK, WEEK,
    "service = 'svc-1' AND route <> '/view' AND regexp_full_match(status, '[24]..')"
    " AND NOT regexp_full_match(instance, '1|i1')",
    service="=svc-1", route="!=/view", status="=~[24]..", instance="!~1|i1",
)


def _series_sql(family: Family, seconds: int, step: int, scale: str) -> str:
    keys = ", ".join(family.names)
    return (
        f"WITH {family.sql_increase(seconds, step)}"
        f" SELECT {keys}, at_epoch, round(v{scale}, {DIGITS}) AS value FROM i"
    )


@query("prom_rate", _series_sql(D.HTTP, DAY, HALF, f" / {DAY}.0"))
def prom_rate(t: Tables) -> DataFrame:
    vector = M.rate(D.HTTP.samples(t), DAY, step=HALF)
    return shown(labelled(vector, D.HTTP.names), D.HTTP.names)


@query("prom_increase", _series_sql(D.HTTP, DAY, DAY, ""))
def prom_increase(t: Tables) -> DataFrame:
    vector = M.increase(D.HTTP.samples(t), DAY, step=DAY)
    return shown(labelled(vector, D.HTTP.names), D.HTTP.names)


@query(
    "prom_delta",
    f"""
    WITH {D.MEMORY.sql_ranged(DAY, HALF)}
    SELECT namespace, pod, container, image, at_epoch,
           round(arg_max(v, t) - arg_min(v, t), {DIGITS}) AS value
    FROM r GROUP BY ALL HAVING count(*) >= 2
    """,
)
def prom_delta(t: Tables) -> DataFrame:
    vector = M.delta(D.MEMORY.samples(t), DAY, step=HALF)
    return shown(labelled(vector, D.MEMORY.names), D.MEMORY.names)


@query(
    "prom_instant",
    f"""
    WITH {D.UP.sql_instant(QUARTER, QUARTER)}
    SELECT job, instance, at_epoch, round(v, {DIGITS}) AS value FROM i
    """,
)
def prom_instant(t: Tables) -> DataFrame:
    vector = M.instant(D.UP.samples(t), step=QUARTER, lookback=QUARTER)
    return shown(labelled(vector, D.UP.names), D.UP.names)


@query(
    "prom_targets_down",
    f"""
    WITH {D.UP.sql_instant(QUARTER, QUARTER)}
    SELECT job, instance, at_epoch, round(v, {DIGITS}) AS value FROM i WHERE v = 0
    """,
)
def prom_targets_down(t: Tables) -> DataFrame:
    vector = M.instant(D.UP.samples(t), step=QUARTER, lookback=QUARTER)
    return shown(labelled(vector.filter(F.col("value") == 0), D.UP.names), D.UP.names)


@query(
    "prom_sum_without",
    f"""
    WITH {D.HTTP.sql_increase(DAY, DAY)}
    SELECT service, status, at_epoch, round(sum(v), {DIGITS}) AS value FROM i GROUP BY ALL
    """,
)
def prom_sum_without(t: Tables) -> DataFrame:
    vector = M.increase(D.HTTP.samples(t), DAY, step=DAY)
    left = M.sum_without(vector, ["route", "instance"])
    return shown(
        left.select(
            F.col("series")[0]["value"].alias("service"),
            F.col("series")[1]["value"].alias("status"),
            "at",
            "value",
        ),
        ["service", "status"],
    )


# --- shares -----------------------------------------------------------------------------------


def error_share(t: Tables, seconds: int, step: int) -> DataFrame:
    """Percent of requests answered 5xx per service, in one pass."""
    requests = M.increase(D.HTTP.samples(t), seconds, step=step)
    return M.share(requests, ["service"], status="=~5..")


def success_share(t: Tables, seconds: int, step: int) -> DataFrame:
    return M.share(M.increase(D.PROCESSED.samples(t), seconds, step=step), [], status="=success")


def _share_sql(family: Family, label: str | None, part: str, seconds: int, step: int) -> str:
    keys = "at_epoch" if label is None else f"{label}, at_epoch"
    return (
        f"{family.sql_increase(seconds, step)},"
        f" p AS (SELECT {keys}, sum(v) AS v FROM i WHERE {part} GROUP BY ALL),"
        f" w AS (SELECT {keys}, sum(v) AS v FROM i GROUP BY ALL),"
        f" s AS (SELECT {keys}, CASE WHEN w.v <> 0 THEN round(100 * p.v / w.v, {DIGITS}) END AS value"
        f" FROM p JOIN w USING ({keys}))"
    )


ERROR_SHARE = _share_sql(D.HTTP, "service", "status LIKE '5__'", DAY, QUARTER)
SUCCESS_SHARE = _share_sql(D.PROCESSED, None, "status = 'success'", DAY, HALF)


@query("prom_error_pct", f"WITH {ERROR_SHARE} SELECT service, at_epoch, value FROM s")
def prom_error_pct(t: Tables) -> DataFrame:
    """The share as a division of two vectors, matched on their labels."""
    requests = M.increase(D.HTTP.samples(t), DAY, step=QUARTER)
    failed = M.sum_by(M.matching(requests, status="=~5.."), ["service"])
    return shown(M.ratio(failed, M.sum_by(requests, ["service"]), ["service"]), ["service"])


@query("panel_success_pct", f"WITH {SUCCESS_SHARE} SELECT at_epoch, value FROM s")
def panel_success_pct(t: Tables) -> DataFrame:
    return shown(success_share(t, DAY, HALF), [])


# --- quantiles --------------------------------------------------------------------------------


def _quantile_sql(family: Family, labels: list[str], q: float, seconds: int, step: int) -> str:
    keys = ", ".join([*labels, "at_epoch"])
    return (
        f"{family.sql_increase(seconds, step)},"
        f" b AS (SELECT {keys}, CASE WHEN le = '+Inf' THEN 1e308 ELSE CAST(le AS DOUBLE) END AS u,"
        f" sum(v) AS c FROM i GROUP BY ALL),"
        f" l AS (SELECT *, max(c) OVER (PARTITION BY {keys} ORDER BY u) AS cc FROM b),"
        f" x AS (SELECT *, coalesce(lag(cc) OVER w, 0) AS pc, lag(u) OVER w AS pu,"
        f" max(cc) OVER (PARTITION BY {keys}) AS n, max(u) OVER (PARTITION BY {keys}) AS top"
        f" FROM l WINDOW w AS (PARTITION BY {keys} ORDER BY u)),"
        f" y AS (SELECT {keys}, u, CASE WHEN u = 1e308 THEN pu ELSE coalesce(pu, 0)"
        f" + (u - coalesce(pu, 0)) * ({q} * n - pc) / (cc - pc) END AS a FROM x"
        f" WHERE cc >= {q} * n AND n > 0 AND top = 1e308),"
        f" d AS (SELECT DISTINCT {keys} FROM b),"
        f" h AS (SELECT {keys}, round((SELECT arg_min(a, u) FROM y WHERE "
        + " AND ".join(f"y.{k} = d.{k}" for k in [*labels, "at_epoch"])
        + f"), {DIGITS}) AS value FROM d)"
    )


def quantile(
    t: Tables, family: Family, labels: list[str], q: float, seconds: int, step: int
) -> DataFrame:
    buckets = M.sum_by(M.increase(family.samples(t), seconds, step=step), [*labels, "le"])
    return M.histogram_quantile(q, buckets, labels)


def quantile_panel(
    name: str, family: Family, labels: list[str], q: float, seconds: int, step: int
) -> None:
    keys = ", ".join([*labels, "at_epoch"])

    def build(t: Tables) -> DataFrame:
        return shown(quantile(t, family, labels, q, seconds, step), labels)

    sql = f"WITH {_quantile_sql(family, labels, q, seconds, step)} SELECT {keys}, value FROM h"
    query(name, sql)(build)


quantile_panel("prom_histogram_quantile", D.HTTP_SECONDS, ["service"], 0.5, DAY, DAY)
quantile_panel("panel_p95_service", D.HTTP_SECONDS, ["service"], 0.95, DAY, HALF)
quantile_panel("panel_p99_route", D.HTTP_SECONDS, ["service", "route"], 0.99, WEEK, DAY)
quantile_panel("panel_job_p95", D.JOB_SECONDS, ["job_name"], 0.95, WEEK, WEEK)
quantile_panel("panel_processing_p95", D.PROCESSING_SECONDS, ["pipeline"], 0.95, DAY, HALF)


# --- jobs -------------------------------------------------------------------------------------

_DAYS_SPARK = "datediff(o_orderdate, DATE '1970-01-01')"
_DAYS_DUCK = "CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT)"


def _last_success(days: str) -> Family:
    amount = f"CASE WHEN o_orderstatus = 'F' THEN {days} * 86400 ELSE 0 END"
    return Family(
        "spark_job_last_success_timestamp_seconds",
        "orders",
        "o_orderdate",
        {"job_name": "o_orderpriority"},
        amount=amount,
        kind="gauge",
        tick=DAY,
    )


_AGE_SQL = (
    f"{_last_success(_DAYS_DUCK).sql_instant(WEEK, DAY)},"
    " a AS (SELECT job_name, at_epoch, CAST(at_epoch - max(v) AS DOUBLE) AS value"
    " FROM i WHERE v > 0 GROUP BY job_name, at_epoch)"
)


def success_age(t: Tables) -> DataFrame:
    latest = M.instant(_last_success(_DAYS_SPARK).samples(t), step=DAY, lookback=WEEK)
    return M.age(M.max_by_labels(latest.filter(F.col("value") > 0), ["job_name"]))


@query("prom_last_success_age", f"WITH {_AGE_SQL} SELECT job_name, at_epoch, value FROM a")
def prom_last_success_age(t: Tables) -> DataFrame:
    return shown(success_age(t), ["job_name"])


@query(
    "jobs_without_success",
    """
    SELECT o_custkey AS job_name, count(*) AS failures FROM orders o
    WHERE o_orderstatus = 'P' AND NOT EXISTS (
      SELECT 1 FROM orders s WHERE s.o_custkey = o.o_custkey AND s.o_orderstatus = 'F')
    GROUP BY 1
    """,
)
def jobs_without_success(t: Tables) -> DataFrame:
    runs = t.orders.select(F.col("o_custkey").alias("job_name"), "o_orderstatus")
    failed = (
        runs.filter(F.col("o_orderstatus") == "P")
        .groupBy("job_name")
        .agg(F.count(F.lit(1)).alias("failures"))
    )
    good = runs.filter(F.col("o_orderstatus") == "F").select("job_name").distinct()
    return M.jobs_without_success(failed, good, "job_name")


# --- alerts -----------------------------------------------------------------------------------


@query(
    "alert_error_rate",
    f"""
    WITH {ERROR_SHARE},
    f AS (SELECT *, min(CASE WHEN value > 5 THEN 1 ELSE 0 END) OVER w AS ok, count(*) OVER w AS n
          FROM s WINDOW w AS (PARTITION BY service ORDER BY at_epoch
                              RANGE BETWEEN {HALF} PRECEDING AND CURRENT ROW))
    SELECT 'critical' AS severity, service, at_epoch, value FROM f WHERE ok = 1 AND n = 3
    """,
)
def alert_error_rate(t: Tables) -> DataFrame:
    firing = M.held(
        error_share(t, DAY, QUARTER),
        ["service"],
        ~F.isnan("value") & (F.col("value") > 5),
        QUARTER,
        HALF,
    )
    return alert(firing, "critical", ["service"])


def alert(vector: DataFrame, severity: str, labels: list[str], condition: Column | None = None):
    kept = vector if condition is None else vector.filter(~F.isnan("value") & condition)
    return shown(kept, labels).withColumn("severity", F.lit(severity))


@query(
    "alert_latency",
    f"""
    WITH {_quantile_sql(D.HTTP_SECONDS, ['service'], 0.95, DAY, HALF)}
    SELECT 'warning' AS severity, service, at_epoch, value FROM h WHERE value > 200
    """,
)
def alert_latency(t: Tables) -> DataFrame:
    slow = quantile(t, D.HTTP_SECONDS, ["service"], 0.95, DAY, HALF)
    return alert(slow, "warning", ["service"], F.col("value") > 200)


@query(
    "alert_restarts",
    "SELECT 'critical' AS severity, * FROM ("
    + _sum_sql(D.RESTARTS, DAY, HALF, ["namespace", "pod", "container"], "increase")
    + ") WHERE value > 3",
)
def alert_restarts(t: Tables) -> DataFrame:
    labels = ["namespace", "pod", "container"]
    restarts = M.sum_by(M.increase(D.RESTARTS.samples(t), DAY, step=HALF), labels)
    return alert(restarts, "critical", labels, F.col("value") > 3)


@query(
    "alert_job_failed",
    "SELECT 'critical' AS severity, * FROM ("
    + _sum_sql(D.JOB_RUNS, WEEK, WEEK, ["job_name"], "increase", "status = 'failed'")
    + ") WHERE value > 0",
)
def alert_job_failed(t: Tables) -> DataFrame:
    failed = M.matching(D.JOB_RUNS.samples(t), status="=failed")
    runs = M.sum_by(M.increase(failed, WEEK, step=WEEK), ["job_name"])
    return alert(runs, "critical", ["job_name"], F.col("value") > 0)


@query(
    "alert_no_success",
    f"""
    WITH {_AGE_SQL}
    SELECT 'critical' AS severity, job_name, at_epoch, value FROM a WHERE value > {26 * 3600}
    """,
)
def alert_no_success(t: Tables) -> DataFrame:
    return alert(success_age(t), "critical", ["job_name"], F.col("value") > 26 * 3600)


@query(
    "alert_success_rate",
    f"""
    WITH {SUCCESS_SHARE}
    SELECT 'warning' AS severity, at_epoch, value FROM s WHERE value < 95
    """,
)
def alert_success_rate(t: Tables) -> DataFrame:
    return alert(success_share(t, DAY, HALF), "warning", [], F.col("value") < 95)


@query(
    "label_cardinality",
    f"""
    WITH {D.HTTP.sql()}
    SELECT 'service' AS label, count(DISTINCT service) AS "values" FROM m
    UNION ALL SELECT 'route', count(DISTINCT route) FROM m
    UNION ALL SELECT 'status', count(DISTINCT status) FROM m
    UNION ALL SELECT 'instance', count(DISTINCT instance) FROM m
    """,
)
def label_cardinality(t: Tables) -> DataFrame:
    return M.label_cardinality(D.HTTP.samples(t))


@query(
    "label_cardinality_estimate",
    """
    SELECT unnest(['service', 'route', 'status', 'instance']) AS label, true AS near
    """,
)
def label_cardinality_estimate(t: Tables) -> DataFrame:
    """Sketches of two halves of the samples, merged, against the exact number of values."""
    samples = D.HTTP.samples(t)
    late = F.second("ts") % 2 == 0
    halves = M.label_sketches(samples.filter(late)).unionByName(M.label_sketches(samples.filter(~late)))
    exact = M.label_cardinality(samples).withColumnRenamed("values", "exact")
    found = M.estimated_cardinality(halves).join(exact, "label")
    return found.select("label", (F.abs(F.col("values") - F.col("exact")) <= 0.05 * F.col("exact")).alias("near"))


@query(
    "metrics_parse",
    """
    SELECT 'event_total' AS metric, CASE WHEN event_id % 11 <> 3 THEN event_type END AS type,
           CASE WHEN event_id % 11 <> 3 THEN concat('u"', user_id % 7) END AS user_group,
           CASE WHEN event_id % 11 = 3 THEN 'repeated label' END AS error,
           count(*) AS lines, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
           max(CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) // 1000000 END) AS last_second
    FROM events GROUP BY ALL
    """,
)
def metrics_parse(t: Tables) -> DataFrame:
    """Exposition lines written from events and read back."""
    line = F.format_string(
        'event_total{type="%s", %s="u\\"%d"} %s%s',
        F.col("event_type"),
        F.when(F.col("event_id") % 11 == 3, "type").otherwise("user_group"),
        F.col("user_id") % 7,
        F.col("value").cast("string"),
        F.when(
            F.col("event_id") % 2 == 0,
            F.format_string(" %d", F.unix_seconds(F.col("ts").cast("timestamp")) * 1000),
        ).otherwise(""),
    )
    samples = parse_metric_lines(t.events.select(line.alias("value")))
    return samples.groupBy(
        "metric",
        F.col("labels")["type"].alias("type"),
        F.col("labels")["user_group"].alias("user_group"),
        "error",
    ).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        F.max(F.unix_seconds("ts")).alias("last_second"),
    )
