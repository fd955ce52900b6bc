"""Operators that depend on file order: forward fill, occurrence number, newest.

One export may hold a large share of all rows, and so may one repeated value in
it.  No window here spans a whole file: file order is cut into blocks of about
`block` rows, windows work inside a block, and a small table of block summaries
carries what one block needs from those before it.  The cuts follow the row
numbers met, so dense, sparse and uneven numberings give blocks of alike size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from tallyloom.schema import name

BLOCK_ROWS = 1 << 20
PIECES = 256  # quantiles of the row numbers that cuts are taken from, a power of two
BUCKETS = 1 << 16  # of groups by their hash; a group's rows are cut into blocks only where its bucket holds more than one


def _in_blocks(df: DataFrame, order: str, block: int) -> DataFrame:
    """df with `_blk`, which never falls as the row number grows.

    All rows together make as many blocks as hold `block` rows each.  The cuts are
    quantiles of the row numbers over all files, and even steps between two quantiles
    where these are too far apart; a file whose numbering has its rows in one such gap
    still gives at most one row in PIECES to a block.  Any cuts give the same result.
    """
    at = name(order).cast("bigint")
    shares = [i / PIECES for i in range(PIECES)]
    met = df.agg(
        F.struct(
            F.count(at).alias("rows"),
            F.max(at).alias("last"),
            F.percentile_approx(at, shares, PIECES * 40).alias("cuts"),
        )
    ).scalar()
    cuts, wanted = met["cuts"], F.ceil(met["rows"] / F.lit(block))
    # The last cut that isn't above the row number, halving what is left of them each time.
    cut = df.withColumn("_piece", F.lit(0))
    for half in [1 << k for k in reversed(range(PIECES.bit_length() - 1))]:
        further = (wanted > 1) & (F.get(cuts, F.col("_piece") + half) <= at)
        cut = cut.withColumn("_piece", F.col("_piece") + F.when(further, half).otherwise(0))
    cut = cut.withColumns(
        {
            "_low": F.get(cuts, F.col("_piece")),
            "_high": F.coalesce(F.get(cuts, F.col("_piece") + 1), met["last"]),
        }
    )
    steps = F.ceil(wanted / PIECES)
    blk = (
        F.when(wanted <= 1, 0)
        .when(wanted <= PIECES, F.floor(F.col("_piece") * wanted / PIECES))
        .otherwise(F.col("_piece") * steps + _step(at, steps))
    )
    return cut.withColumn("_blk", blk.cast("bigint")).drop("_piece", "_low", "_high")


def _step(at: Column, steps: Column) -> Column:
    """The place of a row number among `steps` even steps from _low to _high."""
    share = (at - F.col("_low")).cast("double") / (F.col("_high") - F.col("_low") + 1)
    return F.least(F.greatest(F.floor(share * steps), F.lit(0)), steps - 1)


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    within: Sequence[str] = ("_path", "_sheet"),
    order: str = "_row_no",
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Replace NULL by the last value above it in the same sheet."""
    keys = [*within, "_blk"]
    blocks = _in_blocks(df, order, block)
    inside = (
        W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    above = (
        W.partitionBy(*within).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    )
    # One row per block: its last value of each column, then the last of all blocks above.
    carry = (
        blocks.groupBy(*keys)
        .agg(
            *[
                F.max_by(
                    F.when(name(c).isNotNull(), name(c)),
                    F.when(name(c).isNotNull(), name(order)),
                ).alias(f"_last_{i}")
                for i, c in enumerate(columns)
            ]
        )
        .select(
            *keys,
            *[
                F.last(f"_last_{i}", ignorenulls=True).over(above).alias(f"_carry_{i}")
                for i in range(len(columns))
            ],
        )
    )
    # The join keys are the window's partitioning, so the big side is shuffled once.
    filled = blocks.withColumns(
        {c: F.last(name(c), ignorenulls=True).over(inside) for c in columns}
    )
    joined = filled.join(carry, keys, "left")
    return joined.select(
        *[
            F.coalesce(name(c), F.col(f"_carry_{columns.index(c)}")).alias(c)
            if c in columns
            else name(c)
            for c in df.columns
        ]
    )


def occurrence(
    df: DataFrame,
    by: Sequence[str],
    order: str = "_row_no",
    out: str = "_nth",
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Number the rows of each group 1, 2, 3 … in file order; NULLs form a group.

    `by` includes the file.  Groups are dealt to buckets by hash, whose rows are counted
    first.  A bucket of at most `block` rows holds no larger group, so its groups are
    numbered whole; that is one shuffle of the rows and no join.  Only rows of larger
    buckets are cut into blocks: there a group has about `block` rows in one window at
    most, however often its value repeats, and blocks that continue a group get an offset.
    """
    _hash = F.xxhash64(*[name(c) for c in by])  # stands first in windows: rows are sorted by a number, mostly
    bucket = F.pmod(_hash, F.lit(BUCKETS))
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    large = counts.filter(F.col("n") > block)  # at most rows / block
    if large.isEmpty():
        whole = W.partitionBy("_hash", *[name(c) for c in by]).orderBy(order)
        numbered = df.withColumn("_hash", _hash).withColumn(out, F.row_number().over(whole))
        return numbered.select(*[name(c) for c in df.columns], F.col(out).cast("bigint").alias(out))
    group = _never_null(df, by)
    keys = ["_hash", *group, "_blk"]
    cut = F.array_contains(large.agg(F.collect_list("bucket")).scalar(), F.col("_bucket"))
    blocks = _in_blocks(df, order, block).withColumns({**group, "_hash": _hash, "_bucket": bucket})
    blocks = blocks.withColumn("_blk", F.when(cut, F.col("_blk")).otherwise(0))
    before = W.partitionBy("_hash", *group).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    # Only blocks that continue a group need an offset; most groups sit in one block.
    offsets = (
        blocks.filter(cut)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.sum("_rows").over(before))
        .filter(F.col("_offset").isNotNull())
        .drop("_rows")
    )
    # The join keys are the window's partitioning, so the big side is shuffled once.
    numbered = blocks.withColumn(
        out, F.row_number().over(W.partitionBy(*keys).orderBy(order))
    )
    return numbered.join(offsets, keys, "left").select(
        *[name(c) for c in df.columns],
        (F.col(out) + F.coalesce(F.col("_offset"), F.lit(0))).alias(out),
    )


def _never_null(df: DataFrame, by: Sequence[str]) -> dict[str, Column]:
    """Key columns equal to `by` as a group, but joinable with plain equality."""
    stand_in = {"string": "''", "date": "DATE'1970-01-01'"}
    group = {}
    for i, c in enumerate(by):
        kind = df.schema[c].dataType.simpleString()
        group[f"_null{i}"] = name(c).isNull()
        group[f"_key{i}"] = F.coalesce(name(c), F.expr(stand_in.get(kind, "0")).cast(kind))
    return group


def number_repeats(
    df: DataFrame,
    label: str,
    by: Sequence[str],
    order: str = "_row_no",
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Append ` #n` to the label of every repeat after the first in its group."""
    nth = F.col("_nth")
    return (
        occurrence(df, [*by, label], order, block=block)
        .withColumn(
            label,
            F.when(nth > 1, F.concat(name(label), F.lit(" #"), nth)).otherwise(name(label)),
        )
        .drop("_nth")
    )


def newest_per_group(df: DataFrame, by: str, recency: Column, item: str) -> DataFrame:
    """One `item` per group: highest recency, then lowest item.  Combines map-side."""
    return df.groupBy(by).agg(
        F.min(F.struct((-recency).alias("age"), name(item).alias("item"))).alias("_best")
    ).select(by, F.col("_best.item").alias(item))
