"""The folder that a cluster shares, and small documents in it that are replaced whole."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session without it has a temporary folder of its own, a cluster gets an error."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="spark-leafmill-")
    return _LOCAL[app]


def fresh(spark: SparkSession, name: str) -> str:
    """A folder below the shared one that nothing else has."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


class Document:
    """A small JSON document that readers see whole, before or after a change (K7): written aside, then renamed."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path  # Hadoop's file API, so that any file system will do
        self.conf = spark._jsc.hadoopConfiguration()
        self.hadoop = self.jvm.org.apache.hadoop.fs

    def read(self) -> dict | None:
        at = self.hadoop.Path(self.path)
        files = at.getFileSystem(self.conf)
        if not files.exists(at):
            return None
        stream = files.open(at)
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def replace(self, content: dict) -> None:
        aside, at = (self.hadoop.Path(p) for p in (f"{self.path}.{uuid.uuid4().hex}.tmp", self.path))
        stream = at.getFileSystem(self.conf).create(aside, True)
        stream.write(json.dumps(content, ensure_ascii=False, indent=2, sort_keys=True).encode())
        stream.close()
        options = self.jvm.java.lang.reflect.Array.newInstance(self.hadoop.Options.Rename.OVERWRITE.getClass(), 1)
        options[0] = self.hadoop.Options.Rename.OVERWRITE
        self.hadoop.FileContext.getFileContext(at.toUri(), self.conf).rename(aside, at, options)
