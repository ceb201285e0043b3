"""Exponential moving average, y = (1 - a) y' + a x with a = 2 / (span + 1).

The recurrence needs every earlier row. A row maps the average before it to the average
after it by y -> exp(-cost) * y + term, and such maps compose to maps of the same form: costs
add up to a `depth`, terms to a discounted sum. So it is a scan of maps, in two levels:

1. over the rows of each (series, chunk): a row's depth since the chunk's first value, and
   what the chunk's rows contribute (`own`);
2. over the chunks of each series, one row per chunk, whose map is that of its last
   value: the average before the chunk, and the average at its first value.

Then y = own + exp(-depth) * (average at the chunk's first value). Level 2 has as many rows per series
as its calendar span has chunks, whatever its number of bars, and no array holds them.

Both levels are the same windows. Sums are kept within blocks of at most `_BLOCK` units
of depth, where exp() stays in the range of a double. A row sums its own block and the
one before; older blocks weigh less than exp(-300), far below the resolution of a double.

The rows are read and shuffled once: the branch that sums chunks up asks for the same
columns as the one that returns rows, so that both read one exchange.

Missing values (NULL or NaN) follow `ewm(span, adjust=False)` of pandas: the last
average is repeated, and the next value weighs a / (a + (1-a)^n), n rows later.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from candlemill.operators.series import CHUNK_DAYS, ORDER, SERIES, calendar_chunk

_BLOCK = 300.0
_LEAST_DECAY = 1e-30  # stands for 0 when span = 1; below the resolution of a double


def add_ema(
    df: DataFrame,
    span: float,
    field: str = "cuote_close",
    name: str = "in_EMA",
    partition_cols: Sequence[str] = SERIES,
    order_col: str = ORDER,
    chunk_days: float = CHUNK_DAYS,
) -> DataFrame:
    """Adds column `name`. (series, order_col) has to be unique and not NULL."""
    if span < 1:
        raise ValueError("span must be at least 1")
    keys = list(partition_cols)
    rows = _within_chunks(df, span, field, keys, order_col, chunk_days)
    starts = _chunk_starts(rows, span, keys, df.columns)
    # Plain equality, so that rows stay where the windows above have put them.
    joined = rows.join(starts, [*keys, "__chunk"], "left")
    value = F.when(F.col("__depth").isNull(), F.col("__before")).otherwise(
        F.col("__own") + F.exp(-F.col("__depth")) * F.col("__start")
    )
    return joined.select(*df.columns, value.alias(name))


def _weights(span: float) -> tuple[float, float, float]:
    alpha = 2.0 / (span + 1.0)
    decay = max(1.0 - alpha, _LEAST_DECAY)
    return alpha, decay, -math.log(decay)


def _within_chunks(
    df: DataFrame, span: float, field: str, keys: list[str], order_col: str, chunk_days: float
) -> DataFrame:
    alpha, _, unit = _weights(span)
    chunk = Window.partitionBy(*keys, "__chunk").orderBy(order_col)
    earlier = chunk.rowsBetween(Window.unboundedPreceding, -1)
    value = F.col(field).cast("double")

    rows = df.withColumns(
        {
            "__chunk": calendar_chunk(df, order_col, chunk_days),
            "__x": F.when(~F.isnan(value), value),
        }
    ).withColumn("__pos", F.row_number().over(chunk))
    filled = F.when(F.col("__x").isNotNull(), F.col("__pos"))
    rows = rows.withColumn("__gap", F.col("__pos") - F.max(filled).over(earlier))

    # Old and new weight of a value that comes __gap rows after the previous one.
    old = F.exp(-unit * F.col("__gap"))
    counted = F.col("__x").isNotNull() & F.col("__gap").isNotNull()
    cost = F.when(F.col("__gap") == 1, F.lit(unit)).otherwise(unit * F.col("__gap") + F.log(old + alpha))
    new = F.when(F.col("__gap") == 1, F.lit(alpha)).otherwise(F.lit(alpha) / (old + alpha))
    rows = rows.withColumns(
        {
            "__cost": F.when(counted, cost).otherwise(F.when(F.col("__x").isNotNull(), F.lit(0.0))),
            "__new": F.when(counted, new),
        }
    )
    rows = rows.withColumn("__term", F.col("__new") * F.col("__x"))
    rows = _scanned(rows, [*keys, "__chunk"], order_col)
    return rows.select(*df.columns, "__chunk", "__x", "__pos", "__depth", "__own")


def _scanned(rows: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Composes the maps y -> exp(-__cost) * y + __term along `order_col`: adds `__depth` and `__own`.

    __depth is NULL before the first __cost; a NULL __term adds nothing.
    """
    so_far = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__depth", F.sum("__cost").over(so_far))
    rows = rows.withColumn("__block", F.coalesce(F.floor(F.col("__depth") / _BLOCK), F.lit(-1)).cast("long"))
    base = F.col("__block") * _BLOCK
    rows = rows.withColumn("__scaled", F.col("__term") * F.exp(F.col("__depth") - base))

    in_block = Window.partitionBy(*keys, "__block").orderBy(order_col)
    by_block = Window.partitionBy(*keys).orderBy("__block")
    rows = rows.withColumn("__sum", F.sum("__scaled").over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
    # A row has a sum once its block has a term. Naming the sum here keeps this window
    # behind the one above, whose sort it can use.
    scaled = F.when(F.col("__sum").isNotNull(), F.col("__scaled"))
    rows = rows.withColumn("__sum_before", F.sum(scaled).over(by_block.rangeBetween(-1, -1)))
    own = F.coalesce("__sum", F.lit(0.0)) + math.exp(-_BLOCK) * F.coalesce("__sum_before", F.lit(0.0))
    own = F.exp(-(F.col("__depth") - base)) * own
    return rows.withColumn("__own", own).drop("__block", "__scaled", "__sum", "__sum_before")


def _chunk_starts(rows: DataFrame, span: float, keys: list[str], columns: list[str]) -> DataFrame:
    """Per chunk: the average before it and the average at its first value."""
    alpha, _, unit = _weights(span)
    filled = F.col("__x").isNotNull()
    position = F.when(filled, F.col("__pos"))
    chunks = rows.groupBy(*keys, "__chunk").agg(
        F.max("__pos").alias("n"),
        F.min(position).alias("first_pos"),
        F.max(position).alias("last_pos"),
        F.min_by("__x", position).alias("first_x"),
        F.max_by("__depth", position).alias("depth"),
        F.max_by("__own", position).alias("own"),
        F.max(F.xxhash64(*columns)).alias("every_column"),
        *[F.first(k).alias(f"__key{i}") for i, k in enumerate([*keys, "__chunk"])],
    )
    # Always true; it asks this branch's exchange for every column, as the other branch does.
    # The join gets copies of the keys, since it would send a filter on the keys themselves below
    # this branch's exchange, which then were another one.
    chunks = chunks.where(F.col("every_column").isNotNull()).drop("every_column")

    series = Window.partitionBy(*keys).orderBy("__chunk")
    earlier = series.rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("begin", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    # Rows from the last value of an earlier chunk to this chunk's first value.
    chunks = chunks.withColumn("gap", F.col("begin") + F.col("first_pos") - F.max(F.col("begin") + F.col("last_pos")).over(earlier))
    old = F.exp(-unit * F.col("gap"))
    counted, first = F.col("first_pos").isNotNull(), F.col("gap").isNull()
    # The average at the first value is `keep` times the average before it, plus `add`.
    chunks = chunks.withColumns(
        {
            "keep": F.when(counted, F.when(first, F.lit(0.0)).otherwise(old / (old + alpha))),
            "add": F.when(counted, F.when(first, F.col("first_x")).otherwise(alpha * F.col("first_x") / (old + alpha))),
        }
    )
    through = F.exp(-F.col("depth"))
    cost = F.when(first, F.lit(0.0)).otherwise(unit * F.col("gap") + F.log(old + alpha) + F.col("depth"))
    chunks = chunks.withColumns({"__cost": F.when(counted, cost), "__term": F.col("own") + through * F.col("add")})
    # A chunk without values has neither cost nor term: it leaves behind what it found.
    chunks = _scanned(chunks, keys, "__chunk").withColumn("__before", F.lag("__own").over(series))
    start = F.when(counted, F.coalesce(F.col("keep") * F.col("__before"), F.lit(0.0)) + F.col("add"))
    copies = [F.col(f"__key{i}").alias(k) for i, k in enumerate([*keys, "__chunk"])]
    return chunks.select(*copies, "__before", start.alias("__start"))
