"""Tables that one application lands as parquet once and reads from then on, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}
_landed: dict[tuple[str, str], str] = {}


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below spark.checkpoint.dir; a local session without that setting gets a temporary one."""
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local.get(app) or _local.setdefault(app, tempfile.mkdtemp(prefix="parlance-"))
    return f"{root.rstrip('/')}/tables-{app}"


def landed(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """make()'s rows, written under a name when first asked for. A write that fails leaves nothing behind that counts."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _landed:
        path = f"{shared_folder(spark)}/{sha256(name.encode()).hexdigest()[:16]}"
        make().write.mode("overwrite").parquet(path)
        _landed[key] = path
    return spark.read.parquet(_landed[key])


def kept(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read from there: its lineage ends here."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Delete all that this application has landed."""
    for key in [k for k in _landed if k[0] == spark.sparkContext.applicationId]:
        del _landed[key]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
