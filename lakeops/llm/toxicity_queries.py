"""The registered toxicity query. It learns, so tests measure it on held-out labels."""

from __future__ import annotations

from lakeops.llm.registry import query, table
from lakeops.llm.toxicity import toxicity_report


@query("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
