"""Guard for tables that are refreshed piece by piece."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Logical operators that map each row on its own.
ROW_LOCAL = {
    "Project", "Filter", "SubqueryAlias", "View", "LogicalRelation", "LogicalRDD",
    "LocalRelation", "RelationV2", "DataSourceV2Relation",
}


class NotIncremental(ValueError):
    """The query needs more than the changed rows and may not back an incremental table."""


def require_row_local(df: DataFrame) -> DataFrame:
    """Return ``df`` if every row depends on one input row only, else raise.

    Joins, aggregates, windows, sorts, limits and non-deterministic expressions are
    refused when the table is defined rather than degrading to full recomputation.
    """
    pending = [df._jdf.queryExecution().analyzed()]
    while pending:
        node = pending.pop()
        name = node.nodeName()
        if name.split(" ")[0] not in ROW_LOCAL:
            raise NotIncremental(f"{name} cannot be refreshed from changed rows alone")
        if not node.deterministic():
            raise NotIncremental(f"{name} is not deterministic")
        children = node.children()
        pending.extend(children.apply(i) for i in range(children.size()))
    return df
