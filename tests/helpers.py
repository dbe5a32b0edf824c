import numpy as np


def frame(spark, **layers):
    """2-D arrays (NaN is nodata) to a pixel table."""
    height, width = next(iter(layers.values())).shape
    names = list(layers)
    rows = [
        (r, c, *[None if np.isnan(layers[n][r, c]) else float(layers[n][r, c]) for n in names])
        for r in range(height)
        for c in range(width)
    ]
    fields = ", ".join(f"{n} DOUBLE" for n in names)
    return spark.createDataFrame(rows, f"row INT, col INT, {fields}")


def array(df, column, shape):
    out = np.full(shape, np.nan)
    for row, col, value in df.select("row", "col", column).collect():
        if value is not None:
            out[row, col] = value
    return out


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange ")
