"""Order lifecycles with a state that ends.

An order's *life* goes from a message that finds no state to the end marker after it, in the order of offsets; its id is the
offset of that message, so it doesn't depend on how messages fall into batches. The end marker removes the state. Messages that come
after it begin another life, and the stored lives of an order together are what a batch over all messages gives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LIFE = "city_code string, order_id string, life long, start_epoch long, end_epoch long, points long, closed boolean"
STATE = "life long, start_epoch long, end_epoch long, points long"


def _joined(state: tuple | None, offsets: np.ndarray, epochs: np.ndarray) -> tuple:
    """State after more points; the times of a life without points are null."""
    life, start, end, points = state or (int(offsets[0]), None, None, 0)
    if len(epochs):
        low, high = int(epochs.min()), int(epochs.max())
        start, end = low if start is None else min(start, low), high if end is None else max(end, high)
    return life, start, end, points + len(epochs)


def fold_messages(state: tuple | None, offset: np.ndarray, epoch: np.ndarray, is_end: np.ndarray) -> tuple[tuple | None, list[tuple]]:
    """The state after some messages of an order, and the rows to store: lives that ended, and the open one."""
    order = np.argsort(offset, kind="stable")
    offset, epoch, is_end = offset[order], epoch[order], is_end[order]
    rows, first = [], 0
    for at in np.flatnonzero(is_end):
        life = _joined(state, offset[first:at + 1], epoch[first:at])
        rows.append((*life, True))
        state, first = None, at + 1
    if first < len(offset):
        state = _joined(state, offset[first:], epoch[first:])
        rows.append((*state, False))
    return state, rows


def lives(tracked: DataFrame, idle_s: int | None = None) -> DataFrame:
    """A streaming frame of lives as they change, from :func:`wayfare.operators.tracks.track_messages`."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        batch = pd.concat(list(frames))
        now, rows = fold_messages(state.getOption, batch["offset"].to_numpy(), batch["epoch"].to_numpy(), batch["is_end"].to_numpy(bool))
        if now is not None:
            state.update(now)
            if idle_s is not None:
                state.setTimeoutDuration(idle_s * 1000)
        elif state.exists:
            state.remove()
        out = pd.DataFrame([(*key, *row) for row in rows], columns=[c.split()[0] for c in LIFE.split(", ")])
        yield out.astype({"start_epoch": "Int64", "end_epoch": "Int64"})

    timeout = GroupStateTimeout.NoTimeout if idle_s is None else GroupStateTimeout.ProcessingTimeTimeout
    return (tracked.select("city_code", "order_id", "offset", "epoch", "is_end").groupBy("city_code", "order_id")
            .applyInPandasWithState(step, LIFE, STATE, "update", timeout))


def orders_of_lives(rows: DataFrame) -> DataFrame:
    """One row per order, with the columns of :func:`wayfare.operators.tracks.order_lifecycle`."""
    return (rows.groupBy("city_code", "order_id")
            .agg(F.min("start_epoch").alias("start_epoch"), F.max("end_epoch").alias("end_epoch"),
                 F.sum("points").alias("points"), F.bool_or("closed").alias("closed"))
            .where(F.col("start_epoch").isNotNull()))
