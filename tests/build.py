"""Small hand-made tables."""

from __future__ import annotations

import datetime as dt

from voidage.sources import schemas


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def pvt_table(spark, points):
    """``points``: (completion, test date, pressure, value); every property has the value."""
    rows = [(c, day(d), p, *([v] * len(schemas.PROPERTIES))) for c, d, p, v in points]
    return spark.createDataFrame(rows, schemas.PVT)


def request_table(spark, requests):
    return spark.createDataFrame([(c, day(d), p) for c, d, p in requests], schemas.REQUEST)


def pressure_table(spark, rows):
    return spark.createDataFrame([(p, day(d), x) for p, d, x in rows], schemas.PATTERN_PRESSURE)


def factor_table(spark, rows):
    return spark.createDataFrame([(p, c, day(d), f) for p, c, d, f in rows], schemas.CONTRIBUTION_FACTOR)


def volume_table(spark, rows):
    """``rows``: dicts of columns; the rest is NULL."""
    names = [f.name for f in schemas.DAILY_VOLUME.fields]
    data = []
    for row in rows:
        row = {**row, "PROD_DATE": day(row["PROD_DATE"])}
        data.append(tuple(row.get(name) for name in names))
    return spark.createDataFrame(data, schemas.DAILY_VOLUME)


def executed_nodes(df) -> list:
    """The nodes of the plan as it was run, subqueries left out; what is reused is one node."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    pending, nodes = [execution.executedPlan()], []
    while pending:
        node = pending.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            pending.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            pending.append(node.plan())
        else:
            nodes.append(node)
            children = node.children()
            pending += [children.apply(i) for i in range(children.size())]
    return nodes
