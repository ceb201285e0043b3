from datetime import datetime, timedelta

import pandas as pd

START = datetime(2025, 1, 1)


def series(spark, closes, index="A", start=START, step=timedelta(hours=1), spread=0.0):
    """Hourly bars with the given closes."""
    rows = [
        (index, start + i * step, c, None if c is None else c + spread, None if c is None else c - spread, c)
        for i, c in enumerate(closes)
    ]
    return spark.createDataFrame(
        rows,
        "`index` string, cuote_timestamp timestamp, cuote_open double, cuote_high double, cuote_low double, cuote_close double",
    )


def full_bars(spark, closes, index="A", start=START, step=timedelta(hours=1)):
    """Bars with every stored field."""
    bars = series(spark, closes, index, start, step)
    return bars.selectExpr(
        "*", "1.0D as volume", "0.0D as asset_volume", "1 as qtde_trades", "0.0D as buy_volume",
        "0.0D as buy_asset_volume", "'0' as ignore",
    )


def in_order(df, *columns) -> list:
    rows = df.orderBy("index", "cuote_timestamp").select(*columns).collect()
    return [r[0] if len(columns) == 1 else tuple(r) for r in rows]


def frame(df) -> pd.DataFrame:
    return df.toPandas().sort_values(["index", "cuote_timestamp"]).reset_index(drop=True)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def stages(node) -> list:
    """Shuffle stages of a plan that has run, reused ones once."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return stages(node.executedPlan())
    below = [stages(node.plan())] if name.endswith("QueryStageExec") else []
    children = node.children()
    below += [stages(children.apply(i)) for i in range(children.length())]
    here = [node] if name == "ShuffleQueryStageExec" else []
    return here + [stage for some in below for stage in some]
