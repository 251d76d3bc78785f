"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.functions.arrays import items_of, joined_or_dash, path_depth

# The two verdicts and their sentences.
PASSED = "OK"
FAILED = "FAILED"
PASSED_TEXT = "The project passed the basic structure check."
FAILED_TEXT = "The project needs corrections before the next check."


def required_missing(manifest: DataFrame, required: str | Column, tree_depth: int = 3) -> DataFrame:
    """(project, path) rows to one verdict per project.

    ``required`` is a comma list; the answer keeps its order. Only required paths are gathered,
    so a project of any size brings no more of them than the list names.
    """
    wanted = items_of(F.lit(required) if isinstance(required, str) else required)
    present = F.collect_set(F.when(F.array_contains(wanted, F.col("path")), F.col("path")))
    shallow = F.count_if(path_depth(F.col("path")) <= tree_depth)
    return (
        manifest.groupBy("project")
        .agg(present.alias("_present"), shallow.alias("listed_paths"))
        .select(
            "project",
            F.array_except(wanted, "_present").alias("_missing"),
            "listed_paths",
        )
        .select(
            "project",
            F.when(F.size("_missing") > 0, FAILED).otherwise(PASSED).alias("status"),
            joined_or_dash(F.col("_missing")).alias("missing_paths"),
            "listed_paths",
        )
    )


def tree_lines(manifest: DataFrame, tree_depth: int = 3) -> DataFrame:
    """The listing of a report: one sorted row per path down to ``tree_depth``."""
    return (
        manifest.filter(path_depth(F.col("path")) <= tree_depth)
        .select("project", F.concat(F.lit("./"), "path").alias("line"))
        .orderBy("project", "line")
    )


def check_report(verdicts: DataFrame, authors: DataFrame) -> DataFrame:
    """One report row per project: name, author, status, missing paths and a summary text."""
    sentence = F.when(F.col("status") == PASSED, PASSED_TEXT).otherwise(FAILED_TEXT)
    return verdicts.join(authors, "project").select(
        "project",
        "author",
        "status",
        "missing_paths",
        F.concat_ws(
            "\n",
            F.concat(F.lit("- Project name: "), F.col("project")),
            F.concat(F.lit("- Author: "), F.col("author")),
            F.concat(F.lit("- Check status: "), F.col("status")),
            F.concat(F.lit("- Missing paths: "), F.col("missing_paths")),
            sentence,
        ).alias("summary"),
    )


def profile(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One pass over ``df``: per rule the rows checked and the rows that fail it."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(
            F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"_bad_{i}")
            for i, rule in enumerate(rules.values())
        ),
    )
    return counted.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(name).alias("rule"),
                        F.col("_rows").alias("checked"),
                        F.col(f"_bad_{i}").alias("failed"),
                    )
                    for i, name in enumerate(rules)
                )
            )
        )
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first per key, as one ``profile`` row."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.sum("n").alias("checked"), F.sum(F.col("n") - 1).alias("failed"))
        .select(F.lit("unique " + ", ".join(keys)).alias("rule"), "checked", "failed")
    )


def broken_references(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key is not in ``parent``, as one ``profile`` row.

    Rows are counted per key before the join, so a frequent key is one row of it.
    """
    per_key = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias("_k"), F.lit(True).alias("_known"))
    return (
        per_key.join(known, "_k", "left")
        .agg(
            F.sum("n").alias("checked"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias(
                "failed"
            ),
        )
        .select(F.lit(f"{key} in {parent_key}").alias("rule"), "checked", "failed")
    )


def observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """Count while another action runs; for watching a job, not for results."""
    observation = Observation(name)
    return df.observe(observation, *(c.alias(n) for n, c in measures.items())), observation
