"""Reports as a folder of versions, published all at once.

A version's tables are written first, each in its own folder, and its manifest last: one small file,
put in place by a rename. Readers follow the newest manifest, so they see a whole version or the one
before; a write that fails leaves no manifest, and so nothing that anyone reads.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Tables that have these columns are partitioned by them.
PARTITIONED_BY = ("sector", "q")


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def publish_reports(reports: dict[str, DataFrame], folder: str, partitioned_by: tuple[str, ...] = PARTITIONED_BY) -> str:
    """Write ``reports`` by name as a new version of ``folder``; returns the version."""
    if not reports:
        raise ValueError("no reports to publish")
    spark = next(iter(reports.values())).sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    for name, report in reports.items():
        by = [c for c in partitioned_by if c in report.columns]
        report.write.partitionBy(*by).parquet(f"{folder}/tables/{version}/{name}")
    manifest = {name: report.schema.jsonValue() for name, report in reports.items()}
    fs, staged = _file_system(spark, f"{folder}/manifests/.{version}")
    out = fs.create(staged)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if not fs.rename(staged, spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifests/{version}")):
        raise OSError(f"version {version} can't be published in {folder}")
    return version


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Published versions, oldest first."""
    fs, path = _file_system(spark, f"{folder}/manifests")
    if not fs.exists(path):
        return []
    return sorted(name for name in (status.getPath().getName() for status in fs.listStatus(path)) if not name.startswith("."))


def read_reports(spark: SparkSession, folder: str, version: str | None = None) -> dict[str, DataFrame]:
    """The tables of a version, the newest if none is named, with the types they were written with."""
    known = versions(spark, folder)
    version = version or (known[-1] if known else None)
    if version not in known:
        raise ValueError(f"{folder} has no published version {version or ''}".rstrip())
    text = spark.read.text(f"{folder}/manifests/{version}", wholetext=True).first()[0]
    return {
        name: spark.read.schema(StructType.fromJson(schema)).parquet(f"{folder}/tables/{version}/{name}")
        for name, schema in json.loads(text).items()
    }
