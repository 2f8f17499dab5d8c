"""Ridge forecast of series of any length: normal equations summed over blocks of samples.

`ridge_predictions` reads a whole series in one task. Here a task reads one block
of its samples: blocks give their part of the normal equations, the parts are
summed in two stages and solved once a series, and the blocks with hold-out
samples are read again with the weights.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.operators.forecast import PREDICTIONS
from marketloom.operators.ridge import normal_equations, predict, solve
from marketloom.operators.series import by_day, fill_gaps
from marketloom.operators.skew import attach
from marketloom.schema import HORIZON, MODEL_INPUTS, SEQUENCE_DAYS, SERIES_DAY, TEST_RATIO

# Samples of one block, and blocks whose sums are added in one task.
BLOCK = 4096
_FAN = 64
_SUMS = "commodity string, part bigint, sums binary"


def _in_blocks(
    daily: DataFrame, days: int, horizon: int, test_ratio: float, purge: int, inputs: Sequence[str], block: int
) -> DataFrame:
    """Scaled rows of every block of samples; rows that two blocks need are in both.

    Sample s reads the rows from s on, as many as `days` and `horizon` together;
    the last sample ends with the series and has no targets.
    """
    whole = Window.partitionBy("commodity")
    filled = fill_gaps(daily.select(*SERIES_DAY, *inputs), inputs)
    numbered = filled.withColumns(
        {"i": F.row_number().over(by_day()) - 1, "n_samples": F.count(F.lit(1)).over(whole) - (days + horizon - 1)}
    )
    share = F.floor(F.col("n_samples") * F.lit(1 - test_ratio))
    split = numbered.withColumn("n_train", F.greatest(F.lit(1), F.least(share, F.col("n_samples") - 1)))

    def of_training(name: str, total) -> Column:
        return total(F.when(F.col("i") < F.col("n_train") + days, F.col(name))).over(whole)

    limits = {}
    for k, name in enumerate(inputs):
        low = of_training(name, F.min)
        span = of_training(name, F.max) - low
        limits |= {f"low{k}": low, f"span{k}": F.when(span == 0, 1.0).otherwise(span)}
    scaled = [((F.col(c) - F.col(f"low{k}")) / F.col(f"span{k}")).alias(f"x{k}") for k, c in enumerate(inputs)]
    first = F.floor(F.greatest(F.col("i") - (days + horizon - 1), F.lit(0)) / block)
    last = F.floor(F.least(F.col("i"), F.col("n_samples") + horizon - 1) / block)
    return split.withColumns(limits).select(
        *SERIES_DAY,
        "i",
        "n_samples",
        "n_train",
        F.greatest(F.col("n_train") - purge, F.lit(1)).alias("n_fit"),
        F.col(inputs[0]).alias("true"),
        F.col("low0").alias("low"),
        F.col("span0").alias("span"),
        *scaled,
        F.explode(F.sequence(first, last)).alias("block"),
    )


def _solved(blocks: DataFrame, days: int, horizon: int, penalty: float, n_inputs: int, block: int) -> DataFrame:
    """(commodity, weights) of every series."""
    names = [f"x{k}" for k in range(n_inputs)]
    width = days * n_inputs + 1

    def of_block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("i")
        values = rows[names].to_numpy()
        n = int(min(block, rows["n_fit"].iloc[0] - rows["block"].iloc[0] * block))
        view = np.lib.stride_tricks.sliding_window_view
        runs = view(values, days, axis=0).transpose(0, 2, 1)[:n]
        sums = np.hstack(normal_equations(runs, view(values[days:, 0], horizon)[:n]))
        return pd.DataFrame(
            {"commodity": rows["commodity"].iloc[:1], "part": rows["block"].iloc[:1] // _FAN, "sums": [sums.tobytes()]}
        )

    def total(rows: pd.DataFrame) -> np.ndarray:
        added = np.zeros((width, width + horizon))
        for part in rows["sums"]:
            added += np.frombuffer(part).reshape(added.shape)
        return added

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.iloc[:1].assign(sums=[total(rows).tobytes()])

    def weigh(rows: pd.DataFrame) -> pd.DataFrame:
        sums = total(rows)
        weights = solve(sums[:, :width], sums[:, width:], penalty)
        return pd.DataFrame({"commodity": rows["commodity"].iloc[:1], "weights": [weights.tobytes()]})

    parts = blocks.where(F.col("block") * block < F.col("n_fit")).groupBy("commodity", "block").applyInPandas(of_block, _SUMS)
    added = parts.groupBy("commodity", "part").applyInPandas(add, _SUMS)
    return added.groupBy("commodity").applyInPandas(weigh, "commodity string, weights binary")


def ridge_in_blocks(
    daily: DataFrame,
    days: int = SEQUENCE_DAYS,
    horizon: int = HORIZON,
    test_ratio: float = TEST_RATIO,
    penalty: float = 1.0,
    purge: int = 0,
    inputs: Sequence[str] = MODEL_INPUTS,
    block: int = BLOCK,
) -> DataFrame:
    """The rows of `ridge_predictions`, of series that need not fit into one task.

    A task holds one block of samples, or the sums of 64 blocks; only the sum of
    those sums, one for each 64 blocks, grows with a series. The series are read
    twice. A block is at least `horizon` long; NULL commodities are a series of
    their own.
    """
    inputs = list(inputs)
    blocks = _in_blocks(daily, days, horizon, test_ratio, purge, inputs, block)
    weights = _solved(blocks, days, horizon, penalty, len(inputs), block)
    names = [f"x{k}" for k in range(len(inputs))]

    def of_block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("i")
        head = rows.iloc[0]
        at, n_samples, n_train = (int(head[c]) for c in ("i", "n_samples", "n_train"))
        solved = np.frombuffer(rows["weights"].dropna().iloc[0]).reshape(-1, horizon)
        view = np.lib.stride_tricks.sliding_window_view
        runs = view(rows[names].to_numpy(), days, axis=0).transpose(0, 2, 1)
        dates, true = rows["obs_date"].to_numpy(), rows["true"].to_numpy()
        test = np.arange(max(n_train - at, 0), max(min(n_samples - at, block), 0))
        # The last run of the series, unless it belongs to the next block.
        last = [n_samples + horizon - 1 - at] if n_samples + horizon - 1 - at < block else []
        taken = np.concatenate([test, last]).astype(int)
        got = predict(runs[taken], solved) * head["span"] + head["low"]
        actual = view(true[days:], horizon)[test].ravel() if len(test) else np.zeros(0)
        kinds = ["test"] * len(test) + ["forecast"] * len(last)
        origins = np.concatenate([dates[days + test], dates[-1:] if last else dates[:0]])
        return pd.DataFrame(
            {
                "commodity": head["commodity"],
                "kind": np.repeat(kinds, horizon),
                "step": np.tile(np.arange(1, horizon + 1, dtype="int32"), len(taken)),
                "origin_date": np.repeat(origins, horizon),
                "actual": np.concatenate([actual, np.full(len(last) * horizon, np.nan)]),
                "prediction": got.ravel(),
            }
        )

    asked = blocks.where((F.col("block") + 1) * block > F.col("n_train"))
    asked = asked.withColumn("_first", F.col("i") == F.col("block") * block)
    ready = attach(asked, weights.withColumn("_first", F.lit(True)), ["commodity", "_first"])
    return ready.groupBy("commodity", "block").applyInPandas(of_block, PREDICTIONS)
