"""An exact, reproducible train and validation split.

Rows are in order of a seeded hash; the first ceil(n * fraction) validate. No row
is ranked globally: a count per hash prefix (65,536 at most) says in which prefix
the border lies, and only that prefix's rows are ranked.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEED, FRACTION = 42, 0.1


def train_val(df: DataFrame, key: str, fraction: float = FRACTION, seed: int = SEED) -> DataFrame:
    """df with `split`: train or val. key: a column that tells rows apart."""
    marked = df.withColumn("__h", F.sha2(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")), 256)).withColumn("__p", F.substring("__h", 1, 4))
    counts = marked.groupBy("__p").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("__n").over(Window.partitionBy(F.lit(0)))
    places = counts.withColumn("__before", before).withColumn("__quota", F.ceil(total * fraction - 1e-9))
    rows = marked.join(places, "__p")
    rank = F.row_number().over(Window.partitionBy("__p").orderBy("__h", key))
    inside = rows.filter((F.col("__before") < F.col("__quota")) & (F.col("__before") + F.col("__n") > F.col("__quota"))).withColumn("split", F.when(F.col("__before") + rank <= F.col("__quota"), "val").otherwise("train"))
    clear = rows.filter((F.col("__before") >= F.col("__quota")) | (F.col("__before") + F.col("__n") <= F.col("__quota"))).withColumn("split", F.when(F.col("__before") < F.col("__quota"), "val").otherwise("train"))
    return clear.unionByName(inside).select(*df.columns, "split")


def split_sizes(split: DataFrame) -> DataFrame:
    return split.agg(F.count("*").alias("total"), F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "val").alias("val"))


def schedule(n_train: int, batch: int = 8, eval_steps: int = 25, save_steps: int = 50) -> dict[str, int]:
    """Steps of an epoch and between evaluations and savings."""
    epoch = max(1, n_train // batch)
    return {"steps_per_epoch": epoch, "eval_steps": max(5, min(eval_steps, epoch)), "save_steps": max(10, min(save_steps, 2 * epoch))}


def schedule_rows(sizes: DataFrame, n_train: str = "train", batch: int = 8, eval_steps: int = 25, save_steps: int = 50) -> DataFrame:
    epoch = F.greatest(F.lit(1), F.floor(F.col(n_train) / batch))
    return sizes.select(epoch.cast("long").alias("steps_per_epoch"), F.greatest(F.lit(5), F.least(F.lit(eval_steps), epoch)).cast("long").alias("eval_steps"), F.greatest(F.lit(10), F.least(F.lit(save_steps), 2 * epoch)).cast("long").alias("save_steps"))


def quota(n: int, fraction: float = FRACTION) -> int:
    return math.ceil(n * fraction - 1e-9)
