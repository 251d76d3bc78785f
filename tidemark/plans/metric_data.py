"""Metric samples derived from the tables, in Spark and as SQL.

A family is scraped every ``tick`` seconds: rows are first counted per (labels, tick), which is
where the table's size ends; counters then run along the ticks of a series and restart whenever
they pass ``modulus``. Label and amount texts are plain SQL that both engines read alike.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.sources.tables import Tables

DAY = 86_400


@dataclass(frozen=True)
class Family:
    metric: str
    table: str
    moment: str
    labels: dict[str, str]
    amount: str = "1"
    kind: str = "counter"  # counter, gauge (highest of the tick) or buckets
    tick: int = 900
    modulus: int = 40
    bounds: list[str] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [*self.labels, *(["le"] if self.kind == "buckets" else [])]

    def _measures(self) -> dict[str, str]:
        if self.kind == "gauge":
            return {"v": f"max({self.amount})"}
        if self.kind == "counter":
            return {"v": f"sum({self.amount})"}
        tests = [f"{self.amount} <= {b}" for b in self.bounds] + ["true"]
        return {f"b{i}": f"sum(CASE WHEN {c} THEN 1 ELSE 0 END)" for i, c in enumerate(tests)}

    def samples(self, t: Tables) -> DataFrame:
        second = F.floor(F.unix_micros(F.col(self.moment).cast("timestamp")) / 1_000_000)
        tick = ((F.floor(second / self.tick) + 1) * self.tick).cast("bigint")
        scraped = (
            getattr(t, self.table)
            .groupBy(*(F.expr(text).alias(n) for n, text in self.labels.items()), tick.alias("tick"))
            .agg(*(F.expr(text).alias(n) for n, text in self._measures().items()))
        )
        if self.kind == "buckets":
            pairs = [
                F.struct(F.lit(le).alias("le"), F.col(f"b{i}").alias("v"))
                for i, le in enumerate([*self.bounds, "+Inf"])
            ]
            scraped = scraped.select(*self.labels, "tick", F.inline(F.array(*pairs)))
        value = F.col("v")
        if self.kind != "gauge":
            along = Window.partitionBy(*self.names).orderBy("tick")
            value = F.pmod(F.sum("v").over(along), F.lit(self.modulus))
        entries = [x for n in self.names for x in (F.lit(n), F.col(n))]
        return scraped.select(
            F.lit(self.metric).alias("metric"),
            F.create_map(*entries).alias("labels"),
            F.timestamp_seconds("tick").alias("ts"),
            value.cast("double").alias("value"),
        )

    def sql(self) -> str:
        """A common table expression ``m`` with the label columns, ``t`` and ``v``."""
        labels = ", ".join(f"{text} AS {n}" for n, text in self.labels.items())
        tick = f"(epoch_us({self.moment}) // 1000000 // {self.tick} + 1) * {self.tick}"
        measures = ", ".join(f"{text} AS {n}" for n, text in self._measures().items())
        scraped = f"SELECT {labels}, {tick} AS t, {measures} FROM {self.table} GROUP BY ALL"
        if self.kind == "gauge":
            return f"m AS (SELECT * REPLACE (CAST(v AS DOUBLE) AS v) FROM ({scraped}))"
        if self.kind == "buckets":
            names = ", ".join(self.labels)
            rows = " UNION ALL ".join(
                f"SELECT {names}, '{le}' AS le, t, b{i} AS v FROM raw"
                for i, le in enumerate([*self.bounds, "+Inf"])
            )
            scraped = f"WITH raw AS ({scraped}) {rows}"
        keys = ", ".join(self.names)
        return (
            f"m AS (SELECT {keys}, t, CAST(sum(v) OVER (PARTITION BY {keys} ORDER BY t)"
            f" % {self.modulus} AS DOUBLE) AS v FROM ({scraped}))"
        )

    def sql_ranged(self, seconds: int, step: int) -> str:
        return (
            f"{self.sql()}, r AS (SELECT *, unnest(range((t + {step} - 1) // {step} * {step},"
            f" t + {seconds}, {step})) AS at_epoch FROM m)"
        )

    def sql_increase(self, seconds: int, step: int) -> str:
        """... and ``i`` with the label columns, ``at_epoch`` and ``v``."""
        keys = ", ".join([*self.names, "at_epoch"])
        return (
            f"{self.sql_ranged(seconds, step)},"
            f" g AS (SELECT *, lag(v) OVER (PARTITION BY {keys} ORDER BY t) AS p FROM r),"
            f" i AS (SELECT {keys}, sum(CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END)"
            f" AS v FROM g GROUP BY {keys} HAVING count(*) >= 2)"
        )

    def sql_instant(self, lookback: int, step: int) -> str:
        keys = ", ".join([*self.names, "at_epoch"])
        return (
            f"{self.sql_ranged(lookback, step)},"
            f" i AS (SELECT {keys}, arg_max(v, t) AS v FROM r GROUP BY {keys})"
        )


SERVICE = "concat('svc-', user_id % 5)"
STATUS = "CASE WHEN event_type = 'error' THEN '500' WHEN event_id % 10 = 0 THEN '404' ELSE '200' END"
CENTS = "CAST(round(value * 100) AS BIGINT)"
CONTAINER = {
    "namespace": "concat('ns-', user_id % 3)",
    "pod": "concat('pod-', user_id % 10)",
    "container": "CASE WHEN event_type = 'error' THEN '' ELSE event_type END",
    "image": "CASE WHEN event_type = 'signup' THEN '' ELSE 'img' END",
}
JOB_STATUS = (
    "CASE WHEN o_orderstatus = 'F' THEN 'success' WHEN o_orderstatus = 'P' THEN 'failed'"
    " ELSE 'running' END"
)
PROCESSING = {
    "pipeline": "concat('p-', user_id % 3)",
    "stage": "event_type",
    "status": "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END",
}
EVENT_BOUNDS = ["5", "10", "25", "50", "100", "250"]

HTTP = Family(
    "http_requests_total",
    "events",
    "ts",
    {
        "service": SERVICE,
        "route": "concat('/', event_type)",
        "status": STATUS,
        "instance": "concat('i', user_id % 2)",
    },
)
HTTP_SECONDS = Family(
    "http_request_duration_seconds_bucket",
    "events",
    "ts",
    {"service": SERVICE, "route": "concat('/', event_type)"},
    amount="value",
    kind="buckets",
    modulus=500,
    bounds=EVENT_BOUNDS,
)
CPU = Family(
    "container_cpu_usage_seconds_total",
    "events",
    "ts",
    CONTAINER,
    amount=CENTS,
    modulus=1_000_000,
)
MEMORY = Family(
    "container_memory_working_set_bytes", "events", "ts", CONTAINER, amount=CENTS, kind="gauge"
)
RESTARTS = Family(
    "kube_pod_container_status_restarts_total",
    "events",
    "ts",
    {
        "namespace": "concat('ns-', user_id % 3)",
        "pod": "concat('pod-', user_id % 10)",
        "container": "concat('c-', user_id % 2)",
    },
    amount="CASE WHEN event_type = 'error' THEN 1 ELSE 0 END",
)
UP = Family(
    "up",
    "events",
    "ts",
    {"job": "concat('job-', event_type)", "instance": "concat('i', user_id % 10)"},
    amount="CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END",
    kind="gauge",
)
POD_PHASE = Family(
    "kube_pod_status_phase",
    "events",
    "ts",
    {
        "namespace": "concat('ns-', user_id % 3)",
        "pod": "concat('pod-', user_id % 10)",
        "phase": "CASE event_id % 4 WHEN 0 THEN 'Pending' WHEN 1 THEN 'Failed'"
        " WHEN 2 THEN 'Unknown' ELSE 'Running' END",
    },
    kind="gauge",
)
JOB_RUNS = Family(
    "spark_job_runs_total",
    "orders",
    "o_orderdate",
    {"job_name": "o_orderpriority", "status": JOB_STATUS},
    tick=DAY,
    modulus=100,
)
JOB_SECONDS = Family(
    "spark_job_duration_seconds_bucket",
    "orders",
    "o_orderdate",
    {"job_name": "o_orderpriority"},
    amount="o_totalprice",
    kind="buckets",
    tick=DAY,
    modulus=500,
    bounds=["50000", "100000", "200000", "300000", "400000"],
)
FAILED_TASKS = Family(
    "spark_stage_failed_tasks_total",
    "lineitem",
    "l_shipdate",
    {
        "app_name": "l_returnflag",
        "stage_id": "CAST(l_linenumber AS VARCHAR(10))",
        "reason": "l_linestatus",
        "executor": "concat('e', l_suppkey % 3)",
    },
    tick=DAY,
    modulus=60,
)
EXECUTOR_MEMORY = Family(
    "spark_executor_memory_used_bytes",
    "lineitem",
    "l_shipdate",
    {"app_name": "l_returnflag", "executor": "concat('e', l_suppkey % 4)"},
    amount="l_quantity",
    kind="gauge",
    tick=DAY,
)
UPLOADS = Family(
    "article_uploads_total",
    "events",
    "ts",
    {"instance": "concat('i', user_id % 4)"},
    amount="CASE WHEN event_type = 'view' THEN 1 ELSE 0 END",
)
PROCESSED = Family("article_processing_total", "events", "ts", PROCESSING)
PROCESSING_SECONDS = Family(
    "article_processing_duration_seconds_bucket",
    "events",
    "ts",
    {"pipeline": "concat('p-', user_id % 3)", "stage": "event_type"},
    amount="value",
    kind="buckets",
    modulus=500,
    bounds=EVENT_BOUNDS,
)
QUEUE_LAG = Family(
    "article_processing_queue_lag",
    "events",
    "ts",
    {
        "queue": "concat('q-', event_type)",
        "consumer_group": "concat('cg-', user_id % 3)",
        "partition": "concat('', user_id % 4)",
    },
    amount=f"{CENTS} % 1000",
    kind="gauge",
)
