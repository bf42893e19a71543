"""Keys of rows to delete from a fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame

FACT_KEYS = ["pdate", "relation_name", "time_stamp", "dataid"]


def keys_to_delete(facts: DataFrame) -> DataFrame:
    return facts.select(*FACT_KEYS)
