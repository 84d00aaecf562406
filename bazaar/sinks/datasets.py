"""Several datasets written as one: readers see all of them or none.

A write makes a new version folder with a Parquet table per dataset and, last, a
manifest (JSON lines: name, folder, rows, columns).  Then the small file ``CURRENT``,
which names the version, is replaced by a rename.  A run that fails before leaves the
version before in place; the next run makes its own folder.  After the rename all but
the newest ``keep`` versions are removed.

The rename is atomic on file systems that have it (HDFS, local).  An object store
replaces a file by put, which is as good here, as ``CURRENT`` is one small object.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CURRENT = "CURRENT"
VERSIONS = "versions"


def _files(spark: SparkSession, path: str):
    """(Hadoop path class, file context, file system) of ``path``."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return fs, fs.FileContext.getFileContext(fs.Path(path).toUri(), conf), fs.Path(path).getFileSystem(conf)


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write ``text`` to ``path`` by way of a temporary file and a rename over it."""
    fs, context, system = _files(spark, path)
    temporary = fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = system.create(temporary, True)
    out.write(bytearray(text.encode()))
    out.close()
    over = spark.sparkContext._jvm.java.lang.reflect.Array.newInstance(fs.Options.Rename.OVERWRITE.getClass(), 1)
    over[0] = fs.Options.Rename.OVERWRITE
    context.rename(temporary, fs.Path(path), over)


def _read(spark: SparkSession, path: str) -> list[str]:
    return [r.value for r in spark.read.text(path).collect()]


def write_datasets(frames: dict[str, DataFrame], path: str, keep: int = 2) -> dict[str, int]:
    """Write ``frames`` below ``path`` as its new version -> rows of each."""
    if not frames:
        raise ValueError("no datasets")
    spark = next(iter(frames.values())).sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/{VERSIONS}/{version}"
    counts, lines = {}, []
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}")
        counts[name] = spark.read.schema(df.schema).parquet(f"{folder}/{name}").count()
        lines.append(json.dumps({"name": name, "folder": name, "rows": counts[name], "columns": df.schema.toDDL()}))
    _put(spark, f"{folder}/manifest.json", "\n".join(lines))
    _put(spark, f"{path}/{CURRENT}", version)
    fs, _, system = _files(spark, path)
    versions = sorted(s.getPath().getName() for s in system.listStatus(fs.Path(f"{path}/{VERSIONS}")))
    for old in versions[:-keep]:
        if old != version:
            system.delete(fs.Path(f"{path}/{VERSIONS}/{old}"), True)
    return counts


def read_datasets(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The datasets of the current version of ``path``, checked against its manifest."""
    folder = f"{path}/{VERSIONS}/{_read(spark, f'{path}/{CURRENT}')[0]}"
    out = {}
    for line in _read(spark, f"{folder}/manifest.json"):
        entry = json.loads(line)
        out[entry["name"]] = spark.read.schema(entry["columns"]).parquet(f"{folder}/{entry['folder']}")
    return out


def union_datasets(frames: dict[str, DataFrame], name: str = "dataset") -> DataFrame:
    """Datasets of equal columns as one frame, with a column that names them."""
    parts = [df.select(F.lit(k).alias(name), "*") for k, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
