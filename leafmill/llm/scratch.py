"""Tables that cut lineage, in the folder that the cluster shares.

``keep`` writes a DataFrame as Parquet below ``spark.checkpoint.dir`` and reads it back, so
that what follows neither recomputes it nor depends on the executor that made it.  Where
the setting is absent, a local session (as in tests) makes a temporary folder once, and a
cluster is told to set it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="spark-leafmill-")
    return _LOCAL[app]


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table of its own and return a scan of it, schema unchanged."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(df: DataFrame, *names: str) -> str | list[str]:
    """``names`` with as many underscores before each as make it no column of ``df`` (in any case)."""
    used, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out[0] if len(out) == 1 else out


def column(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def own_names(df: DataFrame, *outputs: str) -> dict[str, str]:
    """New names of the columns of ``df`` whose names are those of ``outputs``: ``_in`` is put after them."""
    taken, used, out = {x.lower() for x in outputs}, {c.lower() for c in df.columns}, {}
    for c in df.columns:
        name = c
        while name.lower() in taken or name != c and name.lower() in used:
            name = f"{name}_in"
        used.add(name.lower())
        out[c] = name
    return out
