"""Copies of the tables without rows, and with rows that are null in every column, repeated ones and clashing extra columns."""

from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

EXTRA = {"score": "x", "cut": "y", "node": "z", "part": "p", "key": "k", "form_": "f", "value": "v", "field": "g"}


def empty_tables(spark, sf, folder) -> str:
    for path in glob.glob(f"{sf}/*.parquet"):
        spark.read.parquet(path).limit(0).write.parquet(f"{folder}/{os.path.basename(path)}")
    return str(folder)


def dirty_tables(spark, sf, folder) -> str:
    for path in glob.glob(f"{sf}/*.parquet"):
        t = spark.read.parquet(path)
        nulls = spark.range(3).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in t.schema.fields])
        both = t.unionByName(nulls).unionByName(t.limit(20))
        for name, v in EXTRA.items():
            if name not in t.columns:
                both = both.withColumn(name, F.lit(v))
        both.write.parquet(f"{folder}/{os.path.basename(path)}")
    return str(folder)
