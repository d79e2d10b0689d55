"""The state of one area between batches: its open run and the messages that may still be joined by earlier ones."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd

from freshet.plans.history import HEIGHT, OFF, TIE

DAY = 86_400_000_000        # microseconds
EMPTY = {"start": None, "end": None, "start_level": None, "peak_level": None, "n": 0, "ended_by": None}


def add_message(run: dict, message: list) -> dict:
    """A run with one more message [time, level, kind]; a switch-off ends it."""
    time, level, kind = message
    if level == OFF:
        return {**run, "end": time, "ended_by": "dropped_from_feed" if kind == "closed_fallback" else "no_longer_in_force"}
    first = run["n"] == 0
    higher = first or HEIGHT.get(level, 0) > HEIGHT.get(run["peak_level"], 0)
    return {**run, "n": run["n"] + 1, "start": time if first else run["start"], "start_level": level if first else run["start_level"],
            "peak_level": level if higher else run["peak_level"]}


def runs_of(number: int, run: dict, messages: list[list]) -> list[tuple[int, dict]]:
    """The open run carried on over ordered messages, and the runs after it; the last one is open, maybe empty."""
    found = [(number, run)]
    for message in messages:
        number, run = found[-1]
        found[-1] = (number, add_message(run, message))
        if message[1] == OFF:
            found.append((number + 1, dict(EMPTY)))
    return found


COLUMNS = ["area_code", "run", "start_time", "end_time", "start_level", "peak_level", "n_messages", "ended_by", "stale_open"]
NO_TIME = np.datetime64("NaT").astype(np.int64)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    """Rows of :data:`COLUMNS`; times are microseconds and become timestamps a column at a time."""
    columns = dict(zip(COLUMNS, zip(*rows)))
    for name in ("start_time", "end_time"):
        columns[name] = np.array([NO_TIME if v is None else v for v in columns[name]], dtype=np.int64).view("datetime64[us]")
    return pd.DataFrame(columns)


def episodes_of_area(stale_days: int):
    """The function that Spark calls per area and batch, or when its timer has run out."""
    stale_after = stale_days * DAY

    def step(key, batches: Iterator[pd.DataFrame], state):
        area = key[0]
        memory = json.loads(state.get[0]) if state.exists else {"run": 0, "open": EMPTY, "pending": [], "told": {}}
        out, pending = [], {(m[0], m[1]): m for m in memory["pending"]}
        for batch in batches:
            times = batch["time"].to_numpy(dtype="datetime64[us]").view(np.int64)
            for at, level, kind in zip(times.tolist(), batch["level"], batch["kind"]):
                if at == NO_TIME:
                    continue
                pending.setdefault((at, level), [at, level, kind])
        messages = sorted(pending.values(), key=lambda m: (m[0], TIE.get(m[1], -1)))
        now = state.getCurrentWatermarkMs() * 1000
        found = runs_of(memory["run"], memory["open"], messages)
        told = {}
        for number, run in found:
            stale = run["end"] is None and run["start"] is not None and now > run["start"] + stale_after
            told[str(number)] = mark = json.dumps([run, stale])
            before = memory["told"].get(str(number))
            if mark != before and (run["n"] or before):
                out.append((area, number, run["start"], run["end"], run["start_level"], run["peak_level"], run["n"], run["ended_by"] or "open", stale))
        settled = [m for m in messages if m[0] < now]
        kept = runs_of(memory["run"], memory["open"], settled)[-1]
        memory = {"run": kept[0], "open": kept[1], "pending": messages[len(settled):], "told": {n: m for n, m in told.items() if int(n) >= kept[0]}}
        state.update((json.dumps(memory),))
        number, run = found[-1]
        if run["n"] and run["end"] is None and now <= run["start"] + stale_after:
            state.setTimeoutTimestamp(max(run["start"] + stale_after, now) // 1000 + 1)
        if out:
            yield _frame(out)

    return step
