"""Written blocks of rows are small, so what readers hold of them is bounded, and no row is lost in them."""

import numpy as np
from pyspark.sql import functions as F

from skyledger.operators import logistic


def _rows(spark, n, width):
    values = F.array(*[(F.col("id") * (i + 1)).cast("double") for i in range(width)])
    return spark.range(0, n, 1, 2).select(values.alias("features"), (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 3).cast("int").alias("fold"))


def test_logistic_blocks_are_small_and_whole(spark):
    n, width = 9000, 40
    blocks = logistic.pack(_rows(spark, n, width), "features", "label", "fold")
    assert blocks.agg(F.max(F.octet_length("x"))).head()[0] <= logistic.BLOCK_BYTES
    parts = list(logistic._unpacked(blocks.toArrow().to_batches()))
    assert max(len(x) for _, x, _ in parts) <= logistic.ROWS and len(parts) < blocks.count() / 4
    ids = []
    for c, x, y in parts:
        assert (x == x[:, :1] * np.arange(1, width + 1)).all() and (x[:, 0] % 3 == c).all() and (x[:, 0] % 2 == y).all()
        ids += x[:, 0].tolist()
    assert sorted(ids) == list(range(n))


def test_a_row_wider_than_a_block_is_a_block(spark):
    width = logistic.BLOCK_BYTES // 8 + 3
    blocks = logistic.pack(_rows(spark, 5, width), "features", "label")
    assert [r["rows"] for r in blocks.collect()] == [1] * 5
    cut = [b.slice(k, 1) for b in blocks.toArrow().to_batches() for k in range(b.num_rows)]
    assert sorted(x[0, 0] for _, x, _ in logistic._unpacked(cut)) == list(range(5))
