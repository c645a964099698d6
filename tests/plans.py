"""What a physical plan holds, read before any action so that adaptive plans show once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(df: DataFrame, operator: str) -> int:
    return plan_text(df).count(operator)


def scanned_rows(df: DataFrame) -> list[int]:
    """Rows each Parquet scan of an executed query handed on, after row groups were skipped."""
    df.collect()
    rows: list[int] = []

    def walk(node) -> None:
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            rows.append(node.metrics().apply("numOutputRows").value())
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in name:
            walk(node.plan())
        else:
            children = node.children()
            for i in range(children.size()):
                walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return rows
