"""SRC-06: warehouse dimension extract for the planned batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from itemtrack.operators.common import join_split
from itemtrack.operators.lookups import market_to_code

DIMENSION_COLUMNS = [
    "asin", "marketplace_id", "pkg_length", "pkg_width", "pkg_height", "pkg_weight",
    "pkg_dimensional_uom", "pkg_weight_uom", "item_length", "item_width", "item_height",
    "item_weight",
]


def dimension_extract(warehouse: DataFrame, batch: DataFrame, codes: DataFrame,
                      regions: DataFrame) -> DataFrame:
    """The 12 dimension columns of warehouse rows whose region id is in the set
    of their market (FLT-05), whose market code is a batch's market and whose
    item is in that batch (JON-07).

    ``batch`` holds (item_id, market); ``regions`` holds (market, region_id).
    Both filters are semi joins without hints: adaptive execution broadcasts a side
    whose measured size is small; a hot item is split in the shuffled form.
    """
    cmap = market_to_code(codes)
    code_regions = (regions.join(cmap, "market")
                    .select(F.col("market_code").alias("_mc"), F.col("region_id").alias("_rg")))
    keys = (batch.select("item_id", "market").distinct().join(cmap, "market")
            .select(F.col("item_id").alias("asin"), F.col("market_code").alias("marketplace_id")))
    rows = warehouse.join(
        code_regions,
        (F.col("marketplace_id") == F.col("_mc")) & (F.col("region_id") == F.col("_rg")),
        "left_semi")
    rows = join_split(rows, keys.distinct(), ["asin", "marketplace_id"], "left_semi")
    carry = [c for c in ("seq",) if c in warehouse.columns]
    return rows.select(*DIMENSION_COLUMNS, *carry)
