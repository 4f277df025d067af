"""Training rows and factors cut into blocks, kept as files in the shared folder.

Users and items are hashed into B blocks each.  ``cell-a-b`` holds the rows of
user block a and item block b, ``user-a`` and ``item-b`` the ids of a block;
``<fit>-u-a-<t>`` and ``<fit>-i-b-<t>`` are a fit's factors of a block after t
steps.  A training step is one flat Spark job whose tasks read the blocks they
need and write the ones they changed: nothing is shuffled between steps, the
plan of a step does not grow with B or with the number of steps, and a lost
executor costs the steps' unfinished tasks only.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scratch_path
from ..sources.blockfiles import drop_block, load_block, save_block

ROWS_PER_CELL = 200_000
IDS_PER_BLOCK = 65_536
#: Rows of a user block below which more blocks are not worth their steps.
ROWS_PER_TASK = 40_000
SALT = {"user": 17, "item": 29}


def hash_block(col, nb: int, side: str):
    return F.pmod(F.xxhash64(col, F.lit(SALT[side])), F.lit(nb)).cast("int")


def _done(n: int) -> pa.Table:
    return pa.table({"n": pa.array([n], pa.int64())})


class Cells:
    """Rows (u, i, r) written as cell files; B follows from the data alone or is an argument.

    ``tasks``: blocks that are made for the sake of parallel tasks as long as each has ROWS_PER_TASK rows.
    """

    def __init__(self, rows: DataFrame, blocks: int | None = None, rows_per_cell: int = ROWS_PER_CELL,
                 ids_per_block: int = IDS_PER_BLOCK, tasks: int = 1):
        self.spark = rows.sparkSession
        checkpoint_dir(self.spark)
        self.folder = scratch_path(self.spark, "cells")
        rows = rows.select(F.col("u").cast("long").alias("u"), F.col("i").cast("long").alias("i"),
                           F.col("r").cast("double").alias("r")).checkpoint()
        s = rows.agg(F.avg("r").alias("mean"), F.avg(F.when(F.col("r") != 0, F.col("r"))).alias("weight"),
                     F.countDistinct("u").alias("n_users"), F.countDistinct("i").alias("n_items"),
                     F.count(F.lit(1)).alias("n")).first()
        self.mean, self.weight = float(s["mean"] or 0.0), float(s["weight"] or 1.0)
        self.n, self.n_users, self.n_items = s["n"], s["n_users"], s["n_items"]
        self.blocks = nb = blocks or max(1, math.ceil(math.sqrt(self.n / rows_per_cell)),
                                         math.ceil(max(self.n_users, self.n_items) / ids_per_block),
                                         min(tasks, math.ceil(self.n / ROWS_PER_TASK)))
        folder = self.folder

        def write_cell(key, table):
            order = np.lexsort((table.column("i").to_numpy(), table.column("u").to_numpy()))
            save_block(folder, f"cell-{key[0].as_py()}-{key[1].as_py()}",
                       **{c: table.column(c).to_numpy()[order] for c in ("u", "i", "r")})
            return _done(len(order))

        def write_ids(key, table):
            side = "user" if key[0].as_py() == 0 else "item"
            save_block(folder, f"{side}-{key[1].as_py()}", ids=np.sort(table.column("id").to_numpy()))
            return _done(table.num_rows)
        cut = rows.select(hash_block(F.col("u"), nb, "user").alias("a"), hash_block(F.col("i"), nb, "item").alias("b"),
                          "u", "i", "r")
        cut.groupBy("a", "b").applyInArrow(write_cell, "n long").agg(F.sum("n")).collect()
        ids = (rows.select(F.lit(0).alias("side"), F.col("u").alias("id")).distinct()
               .unionByName(rows.select(F.lit(1).alias("side"), F.col("i").alias("id")).distinct()))
        block = F.when(F.col("side") == 0, hash_block(F.col("id"), nb, "user")).otherwise(hash_block(F.col("id"), nb, "item"))
        ids.withColumn("block", block).groupBy("side", "block").applyInArrow(write_ids, "n long").agg(F.sum("n")).collect()


def block_ids(folder: str, side: str, block: int) -> np.ndarray:
    found = load_block(folder, f"{side}-{block}")
    return np.empty(0, np.int64) if found is None else found["ids"]


def cell(folder: str, a: int, b: int, users: np.ndarray, items: np.ndarray):
    """(u, i, raw u, raw i, r) of a cell: places in its blocks, raw ids, values."""
    c = load_block(folder, f"cell-{a}-{b}")
    if c is None:
        z = np.empty(0, np.int64)
        return z, z, z, z, np.empty(0)
    return np.searchsorted(users, c["u"]), np.searchsorted(items, c["i"]), c["u"], c["i"], c["r"]


def run_tasks(spark: SparkSession, tasks: list, fn: Callable) -> None:
    """Call ``fn(task)`` once per task, each in a Spark task of its own, in one job."""
    if not tasks:
        return

    def run(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            for n in b.column(0).to_pylist():
                fn(tasks[n])
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64())], names=["n"])
    spark.range(0, len(tasks), 1, len(tasks)).mapInArrow(run, "n long").collect()      # a row per task


def gang_size(spark: SparkSession) -> int:
    """Tasks that can run at the same time, or 0 where that is not known (executors come and go, or the number is set by hand)."""
    conf = spark.sparkContext.getConf()
    if conf.contains("spark.default.parallelism") or conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    return spark.sparkContext.defaultParallelism // int(conf.get("spark.task.cpus", "1"))


def run_gang(spark: SparkSession, n: int, fn: Callable) -> None:
    """Call ``fn(k, token)`` for k below ``n`` in one barrier stage: all tasks run at once, so one may wait for another's file.

    ``token`` is the same for all tasks and new whenever the stage is run again.
    """
    def run(batches: Iterable[pa.RecordBatch]):
        ctx = BarrierTaskContext.get()
        token = ctx.allGather(f"{ctx.taskAttemptId()}")[0]
        fn(ctx.partitionId(), token)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64())], names=["n"])
    spark.range(0, n, 1, n).mapInArrow(run, "n long", barrier=True).collect()


def take_block(folder: str, name: str, wait: float = 3600.0) -> dict[str, np.ndarray]:
    """A block that another task of the gang writes: waited for, read and removed."""
    until, pause = time.monotonic() + wait, 0.002
    while (found := load_block(folder, name)) is None:
        if time.monotonic() > until:
            raise TimeoutError(f"no block {name} in {folder}")
        time.sleep(pause)
        pause = min(2 * pause, 0.05)
    drop_block(folder, name)
    return found


def _numbers(spark: SparkSession, n: int, slices: int) -> DataFrame:
    """0 .. n - 1 in ``slices`` partitions, as a table of unknown size.

    A range is known to be small, and whatever a function makes of its rows is then estimated in proportion: factors of
    millions of ids count as a few bytes and are collected for a broadcast by any join.  With no size known, joins are
    planned as shuffles, and what is small when it runs is still broadcast.
    """
    return spark.createDataFrame(spark.sparkContext.parallelize([(k,) for k in range(n)], slices), "id long")


def tagged_rows(spark: SparkSession, blocks: list[tuple[str, str, str]]) -> DataFrame:
    """(model, id, bias, features) of factor blocks (model, folder, file), read from their files in one scan."""
    def run(batches):
        for b in batches:
            for n in b.column(0).to_pylist():
                tag, folder, name = blocks[n]
                f = load_block(folder, name, ("ids", "m", "b"))
                if f is None:
                    continue
                ids, m, bias = f["ids"], f["m"], f["b"]
                for lo in range(0, len(ids), 8192):
                    hi = min(lo + 8192, len(ids))
                    ends = pa.array(np.arange(hi - lo + 1, dtype=np.int32) * m.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tag] * (hi - lo), pa.string()), pa.array(ids[lo:hi]), pa.array(bias[lo:hi]),
                         pa.ListArray.from_arrays(ends, pa.array(m[lo:hi].ravel()))], names=["model", "id", "bias", "features"])
    return _numbers(spark, len(blocks), max(1, min(len(blocks), 64))).mapInArrow(
        run, "model string, id long, bias double, features array<double>")


def factor_rows(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """(id, bias, features) of the blocks ``names``, read from their files."""
    return tagged_rows(spark, [("", folder, n) for n in names]).drop("model")
