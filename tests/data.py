"""Crafted series and frames."""

import datetime as dt

import numpy as np
import pandas as pd

START = dt.date(2000, 1, 1)


def walk(sizes, seed=0, gap=0.3):
    """Random-walk closes per key on days with gaps; ``sizes`` maps key to rows."""
    rng = np.random.default_rng(seed)
    frames = []
    for key, n in sizes.items():
        days = np.cumsum(rng.integers(1, 4, n) * (rng.random(n) < gap) + 1)
        close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
        open_ = close * np.exp(rng.normal(0, 0.01, n))
        frames.append(pd.DataFrame({"ticker": key, "date": [START + dt.timedelta(int(d)) for d in days],
                                    "open_price": open_, "close_price": close}))
    return pd.concat(frames, ignore_index=True)


def series(key, closes):
    return pd.DataFrame({"ticker": key, "date": [START + dt.timedelta(i) for i in range(len(closes))],
                         "close_price": [float(c) for c in closes]})


def shuffled(spark, pdf, seed=1):
    return spark.createDataFrame(pdf.sample(frac=1, random_state=seed)).repartition(3)


def collected(df, by=("ticker", "date")):
    return df.toPandas().sort_values(list(by)).reset_index(drop=True)
