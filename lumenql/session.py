"""The engine: query text in, DataFrame out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .functions import history, prompts  # noqa: F401  history registers its functions
from .plans.lower import Lowering
from .plans.parser import parse
from .sources.registry import Registry


class Engine:
    """Runs dialect scripts over registered table functions.

    ``options`` steers sources: ``tables`` (folder of Parquet tables), ``snapshots``
    (folder of saved service answers), ``clients`` (a callable for each service schema),
    ``missing_services`` ("empty": a service without either has no rows, else it raises),
    ``jdbc`` and ``sqlite`` (connection options, database file), ``llm_client`` (a callable
    for model functions), ``culture``, ``max_paths`` (lists of places to read),
    ``quoted_line_breaks`` (whether delimited files have them: True, False or "find").
    """

    def __init__(self, spark: SparkSession, **options: object):
        from .sources import basic, can, databases, files, repositories, snapshots

        self.spark, self.options = spark, options
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        self.registry = Registry()
        for module in (basic, files, can, repositories, snapshots, databases):
            module.register(self.registry)

    def sql(self, text: str) -> DataFrame:
        """The result of the script's last query or description."""
        out = Lowering(self).run(parse(text))
        if out is None:
            raise ValueError("the script has no query")
        return out

    def row_library(self, schema: str, args: list[object]) -> dict:
        """Functions that belong to one source's rows by its settings."""
        if schema.lower() in ("openai", "ollama"):
            return prompts.build(self.options.get("llm_client"), {"schema": schema, "arguments": args})
        if schema.lower() == "can":
            from .sources import can

            return can.row_library(self, args)
        return {}
