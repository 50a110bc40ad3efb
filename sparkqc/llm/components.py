"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkqc.llm.common import forget, staged


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every end of ``edges`` (a, b); the component is the smallest id that can be reached.

    Each round contracts the graph: a node goes to its smallest smaller neighbour and on to where that goes, edges
    are renamed, and loops and doubles vanish. The smallest node of a component never moves, so it is what is left of it. The
    edges shrink from round to round; only whether any are left comes to the driver.
    """
    def ordered(rows: DataFrame) -> DataFrame:
        return rows.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()

    left = staged(ordered(edges), "edges")
    names = staged(edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("component", F.col("id")), "components")
    while left.limit(1).count():
        step = staged(left.groupBy(F.col("b").alias("from")).agg(F.min("a").alias("to")), "step")
        on = step.select(F.col("from").alias("_f"), F.col("to").alias("_t"))
        goes = staged(step.join(on, F.col("to") == F.col("_f"), "left").select("from", F.coalesce("_t", "to").alias("to")), "goes")
        at_a = goes.select(F.col("from").alias("_fa"), F.col("to").alias("_ta"))
        at_b = goes.select(F.col("from").alias("_fb"), F.col("to").alias("_tb"))
        forget(step)
        renamed = left.join(at_a, F.col("a") == F.col("_fa"), "left").join(at_b, F.col("b") == F.col("_fb"), "left")
        left, was_left = staged(ordered(renamed.select(F.coalesce("_ta", "a").alias("a"), F.coalesce("_tb", "b").alias("b"))), "edges"), left
        names, was_names = staged(names.join(at_a, F.col("component") == F.col("_fa"), "left").select("id", F.coalesce("_ta", "component").alias("component")), "components"), names
        forget(goes, was_left, was_names)
    forget(left)
    return names
