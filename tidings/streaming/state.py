"""The signal-weight state machine over an outcome stream, one state
per key, with ``applyInPandasWithState``. Each micro-batch folds the key's
new outcomes in date order into the stored state; the result equals the
batch fold (``operators.learning.adjust_weights``) when outcomes arrive in
date order."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidings.operators.learning import (ADJUSTMENT_EVERY, ADJUSTMENT_STEP, DECAY_FACTOR, DECAY_STREAK,
                                        DEFAULT_WEIGHT, MAX_WEIGHT, MIN_WEIGHT, RESTORE_STREAK, SIGNAL_FEATURES)

STATE_SCHEMA = ("w double, cw int, cc int, wa int, ca int, pd double, drift double, n long")
OUT_FIELDS = ["current_weight", "consecutive_wrong", "consecutive_correct", "wrong_since_adjustment",
              "correct_since_adjustment", "pre_decay_weight", "drift", "n_outcomes"]


def _clamp(x: float) -> float:
    return min(max(x, MIN_WEIGHT), MAX_WEIGHT)


def fold(state: tuple, correct_flags) -> tuple:
    """Apply outcomes (1 = correct) in order to (w, cw, cc, wa, ca, pd,
    drift, n)."""
    w, cw, cc, wa, ca, pd_, drift, n = state
    for ok in correct_flags:
        n += 1
        if ok:
            cw, cc, ca = 0, cc + 1, ca + 1
        else:
            cw, cc, wa = cw + 1, 0, wa + 1
        if cw >= DECAY_STREAK and pd_ is None:
            nw = _clamp(w * DECAY_FACTOR)
            pd_, drift, w, cw = w, drift + abs(nw - w), nw, 0
        elif cc >= RESTORE_STREAK and pd_ is not None:
            nw = _clamp(pd_)
            drift, w, pd_, cc = drift + abs(nw - w), nw, None, 0
        if wa >= ADJUSTMENT_EVERY:
            nw = _clamp(w * (1 - ADJUSTMENT_STEP))
            drift, w, wa = drift + abs(nw - w), nw, 0
        elif ca >= ADJUSTMENT_EVERY:
            nw = _clamp(w * (1 + ADJUSTMENT_STEP))
            drift, w, ca = drift + abs(nw - w), nw, 0
    return w, cw, cc, wa, ca, pd_, drift, n


def weight_stream(outcomes: DataFrame, keys: list[str], date_col: str = "date", correct_col: str = "correct",
                  signal_col: str = "signal", signals=tuple(SIGNAL_FEATURES)) -> DataFrame:
    """Stateful per-key weights over a stream of (keys..., date, correct);
    emits the key's current state after each micro-batch (update mode).
    Outcomes of NULL or unknown signals are skipped."""
    outcomes = outcomes.where(F.col(signal_col).isin(list(signals)))
    out_schema = ", ".join([f"{k} string" for k in keys] + [
        "current_weight double", "consecutive_wrong int", "consecutive_correct int", "wrong_since_adjustment int",
        "correct_since_adjustment int", "pre_decay_weight double", "drift double", "n_outcomes long"])

    def step(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            s = state.get
            cur = (s[0], s[1], s[2], s[3], s[4], None if pd.isna(s[5]) else s[5], s[6], s[7])
        else:
            cur = (DEFAULT_WEIGHT, 0, 0, 0, 0, None, 0.0, 0)
        batch = pd.concat(list(pdfs), ignore_index=True).sort_values(date_col, kind="stable")
        cur = fold(cur, batch[correct_col].astype(int).tolist())
        state.update(cur)
        row = dict(zip(keys, key))
        row.update(dict(zip(OUT_FIELDS, cur)))
        yield pd.DataFrame([row])

    return outcomes.groupBy(*keys).applyInPandasWithState(
        step, out_schema, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout)
