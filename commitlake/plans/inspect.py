"""Read physical plans: the checks the tests and the bench use.

These look at the plan Spark chose (before adaptive re-planning, or the
final adaptive plan after an action) and flag the shapes that do not scale:
a shuffle of everything into one partition, a Python UDF on the row path, a
cartesian or nested-loop join.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# Plan nodes that stop a query from scaling out, when found over row data.
RED_FLAGS = {
    # in formatted text the node and its partitioning are on different lines
    "single_partition": re.compile(r"Arguments: SinglePartition"),
    "python_udf": re.compile(
        r"BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroupsIn|FlatMapCoGroupsIn|AggregateInPandas|WindowInPandas"
    ),
    "cartesian": re.compile(r"CartesianProduct"),
    "nested_loop": re.compile(r"BroadcastNestedLoopJoin"),
}


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` would print."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def executed_plan_text(df: DataFrame) -> str:
    """The physical plan as a tree string (final adaptive plan once run)."""
    return df._jdf.queryExecution().executedPlan().toString()


@dataclass
class PlanSummary:
    exchanges: int
    hash_exchanges: int
    range_exchanges: int
    single_partition: int
    broadcasts: int
    flags: dict = field(default_factory=dict)
    pushed_filters: list = field(default_factory=list)
    read_schemas: list = field(default_factory=list)


def summarize(df: DataFrame) -> PlanSummary:
    """Count exchanges and red flags in the planned (pre-adaptive) plan."""
    text = plan_text(df, "formatted")
    tree = text.split("\n\n", 1)[0]
    return PlanSummary(
        exchanges=len(re.findall(r"\bExchange\b", tree)),
        hash_exchanges=len(re.findall(r"hashpartitioning", text)),
        range_exchanges=len(re.findall(r"rangepartitioning", text)),
        single_partition=len(RED_FLAGS["single_partition"].findall(text)),
        broadcasts=len(re.findall(r"BroadcastExchange", tree)),
        flags={k: bool(p.search(text)) for k, p in RED_FLAGS.items()},
        pushed_filters=re.findall(r"PushedFilters: (\[.*\])", text),
        read_schemas=re.findall(r"ReadSchema: (.*)", text),
    )
