"""Merchants and their managers: looked up in batches, merged into the dimension table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import long_id, non_blank

BATCH = 1_000


def wanted(room_config: DataFrame) -> DataFrame:
    """Merchant ids of rooms; 0 means none."""
    return room_config.select(long_id(F.col("merchant_id")).alias("merchant_id")).where("merchant_id is not null and merchant_id <> 0").distinct()


def looked_up(ids: DataFrame, fetch: Callable[[list[int]], list[dict]]) -> DataFrame:
    """What `fetch` knows of the merchants, asked for BATCH ids at a time; if one batch fails, all does."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), BATCH):
                rows = fetch([int(x) for x in frame["id"].iloc[at : at + BATCH]])
                yield pd.DataFrame(rows, columns=["merchant_id", "merchant_name", "merchant_group_config_name", "business_manager_id", "business_manager_name"]).astype("string")

    found = ids.select(F.col("merchant_id").cast("string").alias("id")).mapInPandas(run, "merchant_id string, merchant_name string, merchant_group_config_name string, business_manager_id string, business_manager_name string")
    manager = F.nullif(long_id(F.col("business_manager_id")), F.lit(0).cast("decimal(20,0)"))
    return found.select(long_id(F.col("merchant_id")).alias("merchant_id"), *[non_blank(F.col(c)).alias(c) for c in ("merchant_name", "merchant_group_config_name")], manager.alias("business_manager_id"), non_blank(F.col("business_manager_name")).alias("business_manager_name"))


def upserted(old: DataFrame, new: DataFrame, key: str = "merchant_id") -> DataFrame:
    """Rows of new replace those of old with their key; nothing is deleted."""
    return old.join(new, key, "left_anti").unionByName(new)


def changes(old: DataFrame, new: DataFrame, key: str = "merchant_id") -> DataFrame:
    """One row: how many rows an upsert inserts and how many it really changes."""
    rest = [c for c in new.columns if c != key]
    o = old.select(F.col(key).alias("_key"), F.struct(*rest).alias("_old"))
    joined = new.select(key, F.struct(*rest).alias("_new")).join(o, F.col(key) == F.col("_key"), "left")
    return joined.agg(F.count_if(F.col("_key").isNull()).alias("inserted"), F.count_if(F.col("_key").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new"))).alias("changed"))
