"""Global row numbers without moving all rows to one task."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_LOCAL_INDEX_BITS = 33
#: Row groups of steps: a writer holds one in memory, and steps with texts are the widest rows.
_STEP_ROW_GROUP = 16 << 20


def working_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.conf.set("bankpulse.local.folder", spark.conf.get("bankpulse.local.folder", None) or tempfile.mkdtemp(prefix="bankpulse-"))
    return spark.conf.get("bankpulse.local.folder")


_STAGES: WeakKeyDictionary[SparkSession, list[str]] = WeakKeyDictionary()


def written(frame: DataFrame, keep: bool = False) -> DataFrame:
    """Write once to the shared folder and read back: later uses see the same rows in
    the same layout, no lineage is kept, and a lost executor costs nothing. With ``keep``,
    ``temporary_stages`` leaves it alone."""
    path = f"{working_folder(frame.sparkSession)}/stage-{uuid.uuid4().hex}"
    if not keep:
        _STAGES.setdefault(frame.sparkSession, []).append(path)
    frame.write.option("parquet.block.size", _STEP_ROW_GROUP).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def temporary_stages(spark: SparkSession):
    """Remove, on the way out, the steps that were written inside. What reads them must have
    been written or collected by then."""
    stages = _STAGES.setdefault(spark, [])
    before = len(stages)
    try:
        yield
    finally:
        for path in stages[before:]:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        del stages[before:]


def in_pieces(frame: DataFrame, *keys: Column | str) -> DataFrame:
    """The rows in ``keys`` order, cut into pieces by one range shuffle and written: ``_part`` is the
    piece, ``_local`` the position inside it. Keys end in a unique column, so that any run of
    equal values may be cut."""
    position = F.monotonically_increasing_id()
    return written(
        frame.orderBy(*keys).withColumn("_position", position).withColumns({
            "_part": F.shiftright("_position", _LOCAL_INDEX_BITS),
            "_local": F.col("_position").bitwiseAND(F.lit((1 << _LOCAL_INDEX_BITS) - 1)),
        }).drop("_position")
    )


def numbered(frame: DataFrame, *keys: Column, name: str = "rn") -> DataFrame:
    """Add ``name`` = 1, 2, ... in ``keys`` order over the whole frame, and ``n_rows``.

    Keys must end in a unique column, which also lets the range partitioning cut
    through runs of equal values. One range shuffle sorts the rows; each row keeps its
    position inside its partition; the partition sizes (one row per partition) give
    each partition its start.
    """
    placed = in_pieces(frame, *keys)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
        F.sum("_size").over(W.partitionBy()).alias("n_rows"),
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_local") + 1)
        .drop("_part", "_local", "_start")
    )


def running_totals(frame: DataFrame, group: str, order: list[Column], value: str, name: str) -> DataFrame:
    """Add ``name`` = the sum of ``value`` over the rows of the same ``group`` up to this one, in ``order``.

    ``group`` has no nulls; ``order`` ends in a unique column. A group of any size is cut by
    one range shuffle over (group, order); rows are summed inside a piece, and each piece gets
    the sum of the earlier pieces of its group (one row per piece).
    """
    placed = in_pieces(frame, group, *order)
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part", group).agg(F.sum(value).alias("_sum"))
        .select("_part", group, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    )
    inside = W.partitionBy("_part", group).orderBy("_local").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        placed.withColumn(name, F.sum(value).over(inside))
        .join(starts, ["_part", group])
        .withColumn(name, F.col(name) + F.col("_start"))
        .drop("_part", "_local", "_start")
    )


def ntile(rn: Column, n_rows: Column, groups: int) -> Column:
    """Group number of a row when the first ``n mod groups`` groups get one row more."""
    small = F.floor(n_rows / groups)
    extra = n_rows % groups
    in_large = extra * (small + 1)
    large_group = F.floor((rn - 1) / (small + 1)) + 1
    small_group = extra + F.floor((rn - in_large - 1) / F.nullif(small, F.lit(0))) + 1
    return F.when(rn <= in_large, large_group).otherwise(small_group).cast("int")


def quintile_of_rank(rn: Column, n_rows: Column) -> Column:
    """Quintile on ranks with linear-interpolated cut points, lowest edge included."""
    steps = F.call_function("div", (rn - 1) * 5 + n_rows - 2, F.nullif(n_rows - 1, F.lit(0)))
    return F.greatest(F.lit(1), F.coalesce(steps, F.lit(1))).cast("int")
