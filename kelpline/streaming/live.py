"""Live mode: episodes, grid rows and packets while messages stream in, one state per log.

The state of a log is what the batch windows look back for: the buttons before, the start that is open, and what the open
episode holds. Messages of a micro-batch are ordered by ``seq``; one that comes after a later one was handled is late: it is
left out, as replay never goes back, and counted in ``n_late`` of the episode that closes next. An open episode emits
nothing. With ``idle_s`` the state of a log that has been silent so long is dropped, an episode open in it with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kelpline.operators.segment import START, STOP
from kelpline.operators.video import KEPT

FOUND = "bag string, x_seq long, y_seq long, t_start long, t_stop long, n_late long"
STATE = "last_seq long, start_pressed int, stop_pressed int, x_seq long, t_start long, n_late long"


def _in_order(batches: Iterator[pd.DataFrame], last: int) -> tuple[pd.DataFrame, int]:
    """One log's messages of one micro-batch, whose size the trigger's limits bound, in order, each number once; and how many were late."""
    rows = pd.concat(list(batches)).sort_values("seq", kind="stable")
    fresh = rows[rows["seq"] > last].drop_duplicates("seq")
    return fresh, len(rows) - len(fresh)


def _edges(rows: pd.DataFrame, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """Positions of messages with an edge, whether it starts, whether it stops, and the buttons last seen (-1: none yet)."""
    lists = rows["buttons"].to_numpy()
    valid = np.array([i for i, x in enumerate(lists) if x is not None and len(x) > max(START, STOP)], np.int64)
    if not len(valid):
        return valid, valid.astype(bool), valid.astype(bool), a, b
    now = np.array([(lists[i][START], lists[i][STOP]) for i in valid], np.int64)
    before = np.vstack([[(a, b)], now[:-1]])
    up = (before == 0) & (now == 1)
    at = up.any(1)
    return valid[at], up[at, 0], up[at, 1], int(now[-1, 0]), int(now[-1, 1])


def _with_idle(step: Callable, idle_s: float | None, columns: list[str]) -> tuple[Callable, str]:
    if idle_s is None:
        return step, GroupStateTimeout.NoTimeout

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([], columns=columns)
        else:
            yield from step(key, batches, state)
            state.setTimeoutDuration(int(idle_s * 1000))

    return run, GroupStateTimeout.ProcessingTimeTimeout


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _cut(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last, a, b, x, t, late = state.get if state.exists else (-1, -1, -1, -1, 0, 0)
    rows, n = _in_order(batches, last)
    late += n
    at, starts, stops, a, b = _edges(rows, a, b)
    seqs, times, out = rows["seq"].to_numpy(), rows["t"].to_numpy(), []
    for i, start, stop in zip(at, starts, stops):  # edges only
        if start:
            x, t = int(seqs[i]), int(times[i])
        if stop and x >= 0:
            out.append((key[0], x, int(seqs[i]), t, int(times[i]), late))
            x, late = -1, 0
    state.update((int(seqs[-1]) if len(seqs) else int(last), a, b, int(x), int(t), int(late)))
    yield pd.DataFrame(out, columns=_names(FOUND))


def live_episodes(joystick: DataFrame, idle_s: float | None = None) -> DataFrame:
    """Episodes of a streaming DataFrame ``bag, seq, t, buttons``, as they close; append mode."""
    step, timeout = _with_idle(_cut, idle_s, _names(FOUND))
    return joystick.select("bag", "seq", "t", "buttons").groupBy("bag").applyInPandasWithState(step, FOUND, STATE, "append", timeout)


def live_latest(messages: DataFrame, payload: str = "data") -> DataFrame:
    """``bag, topic, seq, payload``: the latest message of every topic of every log, in update mode; a streaming aggregation."""
    return messages.groupBy("bag", "topic").agg(F.max("seq").alias("seq"), F.max_by(payload, "seq").alias(payload))


PACKETS = "bag string, x_seq long, topic string, seq long"
PACKET_STATE = "last_seq long, start_pressed int, stop_pressed int, x_seq long, topics array<string>, seqs array<long>, keys array<boolean>"


def _buffer(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last, a, b, x = -1, -1, -1, -1
    held = pd.DataFrame({"topic": pd.Series([], dtype=object), "seq": pd.Series([], dtype=np.int64), "keyframe": pd.Series([], dtype=bool)})
    if state.exists:
        last, a, b, x, topics, seqs, keys = state.get
        held = pd.DataFrame({"topic": list(topics), "seq": np.array(list(seqs), np.int64), "keyframe": np.array(list(keys), bool)})
    rows, _ = _in_order(batches, last)
    at, starts, stops, a, b = _edges(rows, a, b)
    packets = rows.loc[rows["keyframe"].notna(), ["topic", "seq", "keyframe"]].astype({"keyframe": bool})
    held = pd.concat([held, packets], ignore_index=True)
    seqs, out = rows["seq"].to_numpy(), []

    def ahead(p: pd.DataFrame) -> pd.DataFrame:
        """The ring: of each camera the latest packets, from the last keyframe among them on."""
        ring = p.groupby("topic", sort=False).tail(KEPT)
        tail = ring["seq"].where(ring["keyframe"]).groupby(ring["topic"]).transform("max")
        return ring[ring["seq"] >= tail]

    def emit(x: int, y: int) -> None:
        p = pd.concat([ahead(held[held["seq"] < x]), held[(held["seq"] >= x) & (held["seq"] < y)]])
        out.append(pd.DataFrame({"bag": key[0], "x_seq": x, "topic": p["topic"].to_numpy(), "seq": p["seq"].to_numpy()}))

    for i, start, stop in zip(at, starts, stops):
        if start:
            x = int(seqs[i])
        if stop and x >= 0:
            emit(x, int(seqs[i]))
            x = -1
    # the ring stays, and what an open episode has gathered
    edge = x if x >= 0 else np.iinfo(np.int64).max
    ring = held[held["seq"] < edge].groupby("topic", sort=False).tail(KEPT)
    keep = pd.concat([ring, held[held["seq"] >= edge]])
    state.update((int(seqs[-1]) if len(seqs) else int(last), a, b, int(x), list(keep["topic"]), [int(v) for v in keep["seq"]], [bool(v) for v in keep["keyframe"]]))
    yield pd.concat(out) if out else pd.DataFrame([], columns=_names(PACKETS))


def live_packets(messages: DataFrame, idle_s: float | None = None) -> DataFrame:
    """``bag, x_seq, topic, seq``: the packets of each episode and camera when it closes, as :func:`video.episode_packets` has them.

    ``messages``: ``bag, seq, t, topic, buttons, keyframe``; ``keyframe`` is null for messages that are no packets. A log
    holds the latest packets of each camera and those of its open episode.
    """
    step, timeout = _with_idle(_buffer, idle_s, _names(PACKETS))
    return messages.select("bag", "seq", "t", "topic", "buttons", "keyframe").groupBy("bag").applyInPandasWithState(step, PACKETS, PACKET_STATE, "append", timeout)


ROWS = "bag string, x_seq long, tick long, state_seq long, action_seq long"
GRID_STATE = "last_seq long, start_pressed int, stop_pressed int, x_seq long, due long, state_seq long, ticks array<long>, states array<long>, actions array<long>"


def _sampler(period: int, offset: int, min_rows: int):
    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, a, b, x, k, held, rows = -1, -1, -1, -1, 0, -1, []
        start = 0
        if state.exists:
            last, a, b, x, start, held, ticks, states, actions = state.get
            k, rows = (0, []) if not ticks else (ticks[-1], list(zip(ticks[:-1], states, actions)))
        out = []
        messages, _ = _in_order(batches, last)
        at, starts, stops, a, b = _edges(messages, a, b)
        seqs, times = messages["seq"].to_numpy(), messages["t"].to_numpy()
        last = seqs[-1] if len(seqs) else last
        edge = dict(zip(at.tolist(), zip(starts, stops)))
        open_ = np.zeros(len(seqs), bool)
        on = x >= 0
        for lo, hi in zip([0, *at.tolist()], [*at.tolist(), len(seqs)]):  # only messages of open episodes are looked at one by one
            on = (edge[lo][0] or on) and not edge[lo][1] if lo in edge else on
            open_[lo:hi] = on
        open_[at] = True
        for i in np.flatnonzero(open_):
            seq, t, begun = int(seqs[i]), int(times[i]), False
            if int(i) in edge:
                if edge[int(i)][0]:
                    x, start, k, held, rows, begun = seq, t, 0, -1, [], True
                if edge[int(i)][1] and x >= 0:
                    if len(rows) >= min_rows:
                        out += [(key[0], x, *r) for r in rows]
                    x = -1
            if x < 0 or begun:
                continue
            due = start + (k + 1) * period
            if due <= t <= due + offset:
                held = seq if held < 0 else held
            elif t > due + offset:
                if held >= 0:
                    rows.append((k, held, seq))
                k, held = k + (t - due - offset) // period + 1, -1
        columns = [[int(r[i]) for r in rows] for i in range(3)]
        state.update((int(last), int(a), int(b), int(x), int(start), int(held), [*columns[0], int(k)], columns[1], columns[2]))
        yield pd.DataFrame(out, columns=["bag", "x_seq", "tick", "state_seq", "action_seq"])

    return step


def live_grid(messages: DataFrame, period: int, offset: int, min_rows: int = 30, idle_s: float | None = None) -> DataFrame:
    """Grid rows of ``bag, seq, t, buttons`` (null buttons for other topics), emitted when their episode stops.

    The rules of the batch sampling, message by message. What a log holds is its open episode's rows, since a new start
    discards them.
    """
    step, timeout = _with_idle(_sampler(period, offset, min_rows), idle_s, _names(ROWS))
    return messages.select("bag", "seq", "t", "buttons").groupBy("bag").applyInPandasWithState(step, ROWS, GRID_STATE, "append", timeout)
