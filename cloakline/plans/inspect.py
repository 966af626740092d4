"""Plan checks: what the executed plan does, without running it twice.

Used by tests and by users who want to assert that a pseudonymization stays
a projection (no Python worker, no shuffle of the data) and that no key bytes
reach the plan text.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from cloakline.keys import Keyring

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow",
                "FlatMapGroupsInPandas", "PythonUDF")


def nodes(plan):
    """All nodes of a JVM plan, the plan below an adaptive one included."""
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        plan = plan.initialPlan()
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


# Logical operators whose result may differ between two runs over equal data:
# which rows they keep, or how ties fall, depends on the order of arrival.
ORDER_DEPENDENT = {"GlobalLimit", "LocalLimit", "Limit", "Offset", "Tail", "Deduplicate", "Sample", "Window",
                   "WithWindowDefinition"}


def is_deterministic(df: DataFrame) -> bool:
    """False if recomputing ``df`` may give other values (rand, random IVs, a limit, ties, ...)."""
    plan = df._jdf.queryExecution().analyzed()
    return all(n.deterministic() and n.nodeName() not in ORDER_DEPENDENT for n in nodes(plan))


def has_exchange(df: DataFrame) -> bool:
    """True if the physical plan shuffles or broadcasts (planned, not executed).

    Such a plan is expensive to run twice, so helpers that read their input
    twice write it once instead.
    """
    return any(n.nodeName().endswith("Exchange") for n in nodes(df._jdf.queryExecution().executedPlan()))


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def python_nodes(df: DataFrame) -> list[str]:
    text = plan_text(df, "simple")
    return [n for n in PYTHON_NODES if n in text]


def exchanges(df: DataFrame) -> list[str]:
    """Exchange lines of the physical plan (shuffles and broadcasts)."""
    text = plan_text(df, "simple")
    return [line.strip() for line in text.splitlines() if re.search(r"\bExchange\b|BroadcastExchange", line)]


def shuffles(df: DataFrame) -> list[str]:
    return [e for e in exchanges(df) if "BroadcastExchange" not in e]


def leaks_key(df: DataFrame, keyring: Keyring) -> bool:
    """True if any key appears (hex or raw) in the extended plan text."""
    text = plan_text(df, "extended").lower()
    for secret in (keyring.enc_key, keyring.iv_key, keyring.ipad, keyring.opad):
        if secret.hex() in text or secret.hex()[:32] in text:
            return True
    return False
