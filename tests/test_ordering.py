from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bankpulse.operators.ordering import ntile, numbered, quintile_of_rank


def test_numbering_equals_a_global_window_under_heavy_ties(spark):
    frame = spark.range(20_000).select(F.col("id"), (F.col("id") % 3).alias("value")).repartition(7)
    ours = numbered(frame, F.desc("value"), F.asc("id"))
    wanted = F.row_number().over(W.orderBy(F.desc("value"), F.asc("id")))
    plain = frame.withColumn("wanted", wanted)
    wrong = ours.join(plain, "id").where((F.col("rn") != F.col("wanted")) | (F.col("n_rows") != 20_000))
    assert wrong.count() == 0
    assert ours.count() == 20_000


def test_numbering_of_nothing(spark):
    assert numbered(spark.range(0), F.col("id")).count() == 0


@pytest.mark.parametrize("groups", [4, 10])
def test_ntile_equals_the_window_function(spark, groups):
    sizes = spark.createDataFrame([(n,) for n in [1, 2, 3, 5, 9, 10, 11, 19, 20, 21, 99, 101]], "n bigint")
    rows = sizes.select("n", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("rn"))
    wanted = F.ntile(groups).over(W.partitionBy("n").orderBy("rn"))
    both = rows.select(ntile(F.col("rn"), F.col("n"), groups).alias("got"), wanted.alias("wanted"))
    assert both.where(~F.col("got").eqNullSafe(F.col("wanted"))).count() == 0


def test_quintile_of_rank_equals_cutting_ranks_at_quantiles(spark):
    expected = []
    for n in [*range(5, 60), 101, 999]:
        labels = pd.qcut(pd.Series(np.arange(1, n + 1)), 5, labels=[1, 2, 3, 4, 5]).astype(int)
        expected += [(n, rank, int(label)) for rank, label in enumerate(labels, 1)]
    frame = spark.createDataFrame(expected, "n bigint, rn bigint, wanted int")
    assert frame.where(quintile_of_rank(F.col("rn"), F.col("n")) != F.col("wanted")).count() == 0


def test_quintile_of_a_single_row(spark):
    frame = spark.createDataFrame([(1, 1)], "rn bigint, n bigint")
    assert frame.select(quintile_of_rank(F.col("rn"), F.col("n"))).first()[0] == 1
