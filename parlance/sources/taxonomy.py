"""Vocabularies: a hand-written TOML file, or the table of published versions."""

from __future__ import annotations

import tomllib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.operators.labels import vocabulary_faults
from parlance.schema import schema


def draft(spark: SparkSession, text: str) -> DataFrame:
    """A vocabulary from TOML: version, and a list `types` of type_id, parent_name, name, description. All faults are told at once."""
    data = tomllib.loads(text)
    rows = [(str(data["version"]), x.get("type_id"), x.get("parent_name"), x.get("name"), x.get("description")) for x in data.get("types", [])]
    if not rows:
        raise ValueError("a vocabulary without types")
    df = spark.createDataFrame(rows, schema("taxonomy"))
    if faults := vocabulary_faults(df).orderBy("type_id", "fault").collect():
        raise ValueError("; ".join(f"{r['type_id']}: {r['fault']}" for r in faults))
    return df


def published(taxonomy: DataFrame, version: str) -> DataFrame:
    return taxonomy.where(F.col("version") == version).orderBy("type_id")


def publish(store, draft: DataFrame) -> None:  # noqa: ANN001
    """Add a checked vocabulary to the store's table. A version that is there already is never changed."""
    version = draft.select("version").distinct().first()[0]
    if published(store.read("taxonomy"), version).take(1):
        raise ValueError(f"version {version} is published already")
    store.append("taxonomy", draft)
