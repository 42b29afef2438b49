"""Helpers that the training-data operators share."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rules: space and the control characters 9 to 13.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in the one that all executors share (spark.checkpoint.dir).

    Where that is unset, a local session takes a folder of its own; on a cluster it's an error, as executors couldn't read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="parlance-")
        _own[spark.sparkContext.applicationId] = root
    return f"{root.rstrip('/')}/parlance-{spark.sparkContext.applicationId}"


def drop_shared(spark: SparkSession) -> None:
    """Delete all tables that this application has stashed; frames that read them can't be used any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stash(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it again: the lineage ends here, and a lost executor costs no rework."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A to Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def literal(values: object, ddl: str) -> Column:
    """A constant of any nested type; Spark folds it once."""
    return F.from_json(F.lit(json.dumps(values)), ddl)


def fresh(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The names, with underscores added until none of df's columns is called so (case does not matter)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, wherever the optimizer moves the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
