"""Persist / reload a factor model (factor tables as Parquet, scalars as JSON)."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ..operators.factors import FactorModel


def save_model(model: FactorModel, path: str) -> str:
    model.user_factors.write.mode("overwrite").parquet(f"{path}/user_factors")
    model.item_factors.write.mode("overwrite").parquet(f"{path}/item_factors")
    meta = {"kind": model.kind, "global_mean": model.global_mean, "divisor": model.divisor,
            "params": {k: str(v) for k, v in model.params.items()}}
    spark = model.user_factors.sparkSession
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
    return path


def load_model(spark: SparkSession, path: str) -> FactorModel:
    meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
    return FactorModel(meta["kind"], spark.read.parquet(f"{path}/user_factors"),
                       spark.read.parquet(f"{path}/item_factors"), float(meta["global_mean"]),
                       float(meta["divisor"]), meta.get("params", {}))
