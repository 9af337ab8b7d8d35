"""Readings a source cannot have had: spikes, stuck values, non-numbers and values beyond reach.

One pass over the frames, vectorised over whole batches of episodes, takes from every reading its residual against
the course of its neighbours (level and slope, the seasonal part of a short recording), and gives, per source and slot, a log-binned
histogram of the residuals and of run lengths, plus the few readings that stand out within their own episode. A
generalised Pareto law fitted to the histogram's peaks over threshold then sets the cutoff of each source and slot at a
fixed risk, and the readings that stood out are held against it.

Defined results: null arrays and null elements are no readings; an episode with fewer than three readings has no
residuals, one with fewer than nine is judged against its median; frames that repeat count once; a null source is a
source of its own; arrays may differ in length, a slot being a position; a slot that is zero throughout an episode is
never stuck; an empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpline.runtime import materialize, small

FIELDS = ("state", "chassis_state", "action")
#: Slots of grippers, which rest at an end stop.
GRIPPERS = {"state": (7, 15), "action": (7, 15)}
END_STOPS = (0.0, 1.0)
#: Slots of quaternions. A quaternion and its negative are the same turn, so a change of sign is a lasting move.
TURNS = {f: (51, 52, 53, 54, 58, 59, 60, 61) for f in ("state", "action")}
#: Frames of an episode that one group holds, and how many it sees of its neighbours.
BLOCK, HALO = 2048, 32
#: Half of the window whose median is the expected reading; a spike may last so many frames.
HALF = 4
#: A reading stands out if its residual is this many times the typical one of its own episode and slot.
LOCAL = 5.0
#: Readings of smaller size are never beyond reach; others are if over REACH times the 99.9 % quantile of their slot.
REACH_FLOOR, REACH = 6.0, 4.0
#: Risk per reading of a cutoff.
RISK = 1e-7
#: Share of the residuals that are peaks, and the largest shape of their law; a heavier tail is not told from spikes.
PEAKS, HEAVY = 0.05, 0.1
#: A run of equal readings is stuck from a length that chance gives with RISK. Chance is the rate of repeats in runs shorter
#: than SHORT_RUN; shorter runs than LEAST_RUN are never looked at.
SHORT_RUN, LEAST_RUN = 8, 4
#: With fewer residuals than this a source's slot is judged by that of all sources.
ENOUGH = 500
#: At the ends of episodes, a source with too few residuals has its inner cutoff times the median ratio of the sources with
#: at least SOME residuals there, in the same slot; where there is none, times EDGE.
SOME, EDGE = 100, 1.5

#: A task hands on its histograms when it has met so many sources, some 150 KB each.
MOST_SOURCES = 512
BINS, SHIFT = 116, 21
_BASE = int(np.float32(2.0**-14).view(np.int32)) >> SHIFT
RUN_BINS = 64

MEASURED = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("source", T.StringType()), T.StructField("field", T.StringType()), T.StructField("slot", T.LongType()),
    T.StructField("episode_idx", T.LongType()), T.StructField("frame_index", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("n", T.LongType()),
])
_ARROW = pa.schema([("kind", pa.string()), ("source", pa.string()), ("field", pa.string()), ("slot", pa.int64()), ("episode_idx", pa.int64()), ("frame_index", pa.int64()), ("x", pa.float64()), ("n", pa.int64())])


def _bins(a: np.ndarray) -> np.ndarray:
    """Quarter octaves of non-negative float32 values, read off their bits; 0 for values under 2^-14."""
    return np.clip((a.view(np.int32) >> SHIFT) - _BASE + 1, 0, BINS - 1)


def bin_top(b: np.ndarray) -> np.ndarray:
    """Upper edge of a bin; 0 for the lowest."""
    b = np.asarray(b, np.int64)
    return np.where(b <= 0, 0.0, ((b + _BASE).astype(np.int32) << SHIFT).view(np.float32).astype(float))


#: Exchanges that bring the median of seven and of nine values to the middle.
_SEVEN = ((0, 5), (0, 3), (1, 6), (2, 4), (0, 1), (3, 5), (2, 6), (2, 3), (3, 6), (4, 5), (1, 4), (1, 3), (3, 4))
_NINE = ((1, 2), (4, 5), (7, 8), (0, 1), (3, 4), (6, 7), (1, 2), (4, 5), (7, 8), (0, 3), (5, 8), (4, 7), (3, 6), (1, 4), (2, 5), (4, 7), (4, 2), (6, 4), (4, 2))


def _middle(p: list[np.ndarray], exchanges: tuple) -> np.ndarray:
    for i, j in exchanges:
        p[i], p[j] = np.minimum(p[i], p[j]), np.maximum(p[i], p[j])
    return p[len(p) // 2]


def expected_course(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the four rows before and after each row make it out to be, and the slope there; the outer four rows are not set.

    The slope is the median of the seven steps around, the expectation the median of the nine readings after they are
    moved along it. So neither a steady move, nor a jump to another level in the midst of one, nor a spike of up to
    four rows moves it.
    """
    m = len(x) - 8
    d = x[1:] - x[:-1]
    slope = np.full_like(x, np.nan)
    slope[4:-4] = _middle([d[1 + i : 1 + i + m] for i in range(7)], _SEVEN)
    out = np.full_like(x, np.nan)
    out[4:-4] = _middle([x[i : i + m] - np.float32(i - 4) * slope[4:-4] for i in range(9)], _NINE)
    return out, slope


def returns(w: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Whether a reading is a departure for a few frames and no side of a lasting jump.

    ``w``: the nine readings around each, along the slope, in columns. A reading of the four before and one of the four
    after, from both of which it departs, must agree within half its residual; or it departs from all eight alike, as
    a single spike right at a jump does.
    """
    x = w[:, 4:5]
    half = np.abs(x - expected[:, None]) / 2
    away = np.where(x >= expected[:, None], x - w, w - x) > half
    found = away[:, [0, 1, 2, 3, 5, 6, 7, 8]].all(1)
    for j in range(4):
        for k in range(5, 9):
            found |= away[:, j] & away[:, k] & (np.abs(w[:, j] - w[:, k]) <= half[:, 0])
    return found


def _matrix(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Rows that have an array, their values (NaN beyond shorter arrays), and where there is no reading at all."""
    rows = np.flatnonzero(col.is_valid().to_numpy(zero_copy_only=False))
    if not len(rows):
        return rows, np.empty((0, 0), np.float32), None
    sub = col.drop_null()
    size = pc.list_value_length(sub).to_numpy(zero_copy_only=False)
    flat = sub.flatten()
    none = flat.is_null().to_numpy(zero_copy_only=False) if flat.null_count else None
    flat = flat.to_numpy(zero_copy_only=False).astype(np.float32, copy=False)
    width = int(size.max())
    if (size == width).all():
        return rows, flat.reshape(-1, width), None if none is None else none.reshape(-1, width)
    at = np.arange(width) < size[:, None]
    out, gone = np.full(at.shape, np.nan, np.float32), ~at
    out[at] = flat
    if none is not None:
        gone[at] = none
    return rows, out, gone


class _Measure:
    def __init__(self, fields: tuple[str, ...], grippers: dict, stops: tuple[float, ...], turns: dict):
        self.fields, self.grippers, self.stops, self.turns = fields, grippers, stops, turns
        self.sources: dict[str | None, int] = {}
        self.hist: dict[tuple[str, str], np.ndarray] = {}
        self.out: list[pa.RecordBatch] = []

    def count(self, kind: str, field: str, source: np.ndarray, cell: np.ndarray, width: int, bins: int) -> None:
        """Add to the histogram of ``kind``; ``cell``: slot * bins + bin of each reading, ``source``: its source's number."""
        n = len(self.sources)
        h = self.hist.get((kind, field))
        if h is None or h.shape[0] < n or h.shape[1] < width:
            grown = np.zeros((max(n, 16), max(width, h.shape[1] if h is not None else 0), bins), np.int64)
            if h is not None:
                grown[: h.shape[0], : h.shape[1]] = h
            h = self.hist[kind, field] = grown
        found = np.bincount(source * (width * bins) + cell, minlength=n * width * bins).reshape(n, width, bins)
        h[:n, :width] += found

    def emit(self, kind: str, field: str, source, slot, episode, frame, x, n) -> None:
        m = len(slot)
        if m:
            const = lambda v: pa.array([v], pa.string()).take(pa.array(np.zeros(m, np.int32)))
            self.out.append(pa.RecordBatch.from_arrays([const(kind), source, const(field), pa.array(slot, pa.int64()), episode, frame, pa.array(x, pa.float64(), from_pandas=False), n], schema=_ARROW))

    def flush(self) -> None:
        names = pa.array(list(self.sources), pa.string())
        for (kind, field), h in self.hist.items():
            s, slot, b = np.nonzero(h)
            none = pa.nulls(len(s), pa.int64())
            self.emit(kind, field, names.take(pa.array(s)), slot, none, none, b.astype(float), pa.array(h[s, slot, b]))
        self.hist, self.sources = {}, {}

    def chunk(self, t: pa.Table) -> None:
        column = lambda c: t.column(c).combine_chunks()
        robots = column("source").dictionary_encode()
        names, codes = robots.dictionary.to_pylist(), robots.indices.fill_null(len(robots.dictionary)).to_numpy(zero_copy_only=False)
        code = np.array([self.sources.setdefault(x, len(self.sources)) for x in [*names, None]])[codes] if robots.null_count else np.array([self.sources.setdefault(x, len(self.sources)) for x in names] or [0])[codes]
        ep, blk, fr = (column(c).to_numpy(zero_copy_only=False) for c in ("episode_idx", "block", "frame_index"))
        own = blk == fr // BLOCK
        for field in self.fields:
            rows, X, none = _matrix(column(field))
            if X.size:
                self.field(field, X, none, rows, ep[rows], blk[rows], fr[rows], own[rows], code[rows])
        if len(self.sources) > MOST_SOURCES:
            self.flush()

    def field(self, field, X, none, rows, ep, blk, fr, own, code) -> None:
        first = np.concatenate([[True], (ep[1:] != ep[:-1]) | (blk[1:] != blk[:-1]) | (fr[1:] != fr[:-1])])
        if not first.all():
            X, ep, blk, fr, own, code = X[first], ep[first], blk[first], fr[first], own[first], code[first]
            none = none[first] if none is not None else None
        n, width = X.shape
        start = np.concatenate([[True], (ep[1:] != ep[:-1]) | (blk[1:] != blk[:-1])])
        s0 = np.flatnonzero(start)
        size = np.diff(np.concatenate([s0, [n]]))
        g = np.cumsum(start) - 1
        lo, hi = s0[g], (s0 + size)[g]
        i = np.arange(n)
        finite = np.isfinite(X)
        bad = ~finite if none is None else ~finite & ~none
        clean = X
        if not finite.all():
            # what is no number gives way to the line between the readings around it (at an end, to the nearest) in the same episode
            known = np.where(finite, i[:, None], -1)
            before = np.maximum.accumulate(known, axis=0)
            after = np.minimum.accumulate(np.where(finite, i[:, None], n)[::-1], axis=0)[::-1]
            take = np.where(before >= lo[:, None], before, np.where(after < hi[:, None], after, 0))
            clean = np.take_along_axis(X, take, axis=0)
            r, k = np.nonzero(~finite & (before >= lo[:, None]) & (after < hi[:, None]))
            b, a = before[r, k], after[r, k]
            with np.errstate(over="ignore", invalid="ignore"):
                clean[r, k] = X[b, k] + (X[a, k] - X[b, k]) * ((r - b) / (a - b)).astype(np.float32)
            clean = np.where(np.isfinite(clean), clean, np.float32(0))
        names = pa.array(list(self.sources), pa.string())

        def put(kind, r, slot, x):
            self.emit(kind, field, names.take(pa.array(code[r])), slot, pa.array(ep[r], pa.int64()), pa.array(fr[r], pa.int64()), x, pa.nulls(len(r), pa.int64()))

        mine = own[:, None]
        r, slot = np.nonzero(bad & mine)
        put("bad", r, slot, np.zeros(len(r)))
        size_of = np.abs(np.where(finite, X, np.float32(0)))
        r, slot = np.nonzero((size_of >= REACH_FLOOR) & mine)
        put("reach", r, slot, size_of[r, slot].astype(float))
        slots = np.arange(width) * BINS
        self.count("level", field, np.repeat(code[own], width), (slots + _bins(size_of[own])).ravel(), width, BINS)

        with np.errstate(invalid="ignore", over="ignore"):
            if n >= 9:
                M, slope = expected_course(clean)
                inner = (i - lo >= HALF) & (hi - 1 - i >= HALF)
                expected = M
                long = (size[g] >= 9) & ~inner
                if long.any():
                    e = np.flatnonzero(long)
                    c = np.clip(e, lo[e] + HALF, hi[e] - 1 - HALF)
                    expected[e] = M[c] + slope[c] * (e - c)[:, None].astype(np.float32)
            else:
                inner, expected = np.zeros(n, bool), np.full_like(X, np.nan)
            for k in np.flatnonzero((size >= 3) & (size < 9)):
                expected[s0[k] : s0[k] + size[k]] = np.median(clean[s0[k] : s0[k] + size[k]], axis=0)
            for k in np.flatnonzero(size < 3):
                expected[s0[k] : s0[k] + size[k]] = np.nan
            R = np.abs(clean - expected)
            known = np.isfinite(R) & finite
            R = np.where(known, R, np.float32(0)).astype(np.float32, copy=False)
            local = (np.add.reduceat(np.sqrt(np.minimum(R, np.float32(1e6))), s0, axis=0) / size[:, None]) ** 2
            out = known & (R > LOCAL * local[g]) & mine
            for k in self.turns.get(field, ()):
                if k < width:
                    # at the ends of an episode, where the change of sign itself may lie
                    out[:, k] &= inner | ~(np.abs(clean[:, k] + expected[:, k]) < np.float32(0.5) * R[:, k])
        for kind, at in (("inner", inner & own), ("edge", ~inner & own)):
            sub = known[at]
            self.count(kind, field, np.repeat(code[at], width)[sub.ravel()], (slots + _bins(R[at])).ravel()[sub.ravel()], width, BINS)
        same = np.zeros(X.shape, bool)
        same[1:] = (X[1:] == X[:-1]) & ~start[1:, None]
        moves = np.maximum.reduceat(size_of, s0, axis=0) > 0
        same &= moves[g]
        counted = moves[g] & finite & mine
        for k in self.grippers.get(field, ()):
            if k < width:
                rest = np.isin(X[:, k], self.stops)
                same[:, k] &= ~rest
                counted[:, k] &= ~rest
        at = np.arange(n, dtype=np.int32)[:, None]
        begin = np.maximum.accumulate(np.where(same, np.int32(0), at), axis=0)
        nxt = np.minimum.accumulate(np.where(same, np.int32(n), at)[::-1], axis=0)[::-1]
        end = np.concatenate([nxt[1:], np.full((1, width), n, np.int32)])
        end = np.minimum(end, hi[:, None])
        length = end - begin
        if n >= 9 and long.any():
            # at the ends of an episode what follows a stuck value is the course again, not a departure from it
            stuck = same & (length >= SHORT_RUN)
            step = np.where(e < c, -1, 1)
            for k in range(4):
                out[e] &= ~stuck[np.clip(c + k * step, 0, n - 1)]
        r, slot = np.nonzero(out)
        at = np.flatnonzero(inner[r])
        if len(at):
            k = np.arange(-HALF, HALF + 1)
            a, b = r[at, None], slot[at, None]
            with np.errstate(invalid="ignore", over="ignore"):
                lasting = ~returns(clean[a + k, b] - k.astype(np.float32) * slope[a, b], expected[r[at], slot[at]])
            r, slot = np.delete(r, at[lasting]), np.delete(slot, at[lasting])
        for kind, at in (("inner?", inner[r]), ("edge?", ~inner[r])):
            put(kind, r[at], slot[at], R[r[at], slot[at]].astype(float))

        r, slot = np.nonzero(counted & ~same)
        self.count("run", field, code[r], slot * RUN_BINS + np.minimum(length[r, slot], RUN_BINS - 1), width, RUN_BINS)
        r, slot = np.nonzero(same & (length >= LEAST_RUN) & mine)
        put("run?", r, slot, length[r, slot].astype(float))


def _measurer(fields, grippers, stops, turns, rows: int):
    names = ["source", "episode_idx", "block", "frame_index", *fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, held, count = _Measure(fields, grippers, stops, turns), [], 0

        def key(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return tuple(b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("episode_idx", "block", "frame_index"))

        last = None
        for b in batches:
            b = b.select(names)
            if not b.num_rows:
                continue
            e, k, f = key(b)
            gaps = np.zeros(b.num_rows, np.int64)
            for j, c in enumerate(fields):
                gaps |= b.column(b.schema.get_field_index(c)).is_null().to_numpy(zero_copy_only=False).astype(np.int64) << j
            now = np.stack([e, k, f, gaps])
            before = np.concatenate([last if last is not None else np.full((4, 1), -(2**62)), now[:, :-1]], axis=1)
            last = now[:, -1:]
            fresh = (now != before).any(0)
            new_group = (now[:2] != before[:2]).any(0)
            cut = 0
            for at in [*np.flatnonzero(new_group), None]:
                if at is None or count + (at - cut) >= rows:
                    stop = b.num_rows if at is None else at
                    part = b.slice(cut, stop - cut).filter(pa.array(fresh[cut:stop]))
                    if part.num_rows:
                        held.append(part)
                        count += part.num_rows
                    cut = stop
                    if at is not None and held:
                        m.chunk(pa.Table.from_batches(held))
                        held, count = [], 0
                        yield from m.out
                        m.out = []
        if held:
            m.chunk(pa.Table.from_batches(held))
        m.flush()
        yield from m.out

    return run


def measure(frames: DataFrame, source: str = "robot", fields: tuple[str, ...] = FIELDS, grippers: dict | None = None, stops: tuple[float, ...] = END_STOPS, turns: dict | None = None) -> DataFrame:
    """Histograms and readings that stand out, as a written table (``kind, source, field, slot, episode_idx, frame_index, x, n``).

    Frames are spread by episode and by blocks of ``BLOCK`` frames that see ``HALO`` frames of their neighbours, so
    neither a long episode nor a source with a third of all rows makes a large task.
    """
    f = frames.filter("episode_idx is not null and frame_index is not null").select(F.col(source).cast("string").alias("source"), F.col("episode_idx").cast("long").alias("episode_idx"), F.col("frame_index").cast("long").alias("frame_index"), *fields)
    b, o = F.floor(F.col("frame_index") / BLOCK), F.pmod("frame_index", F.lit(BLOCK))
    blocks = F.when((o < HALO) & (b != 0), F.array(b - 1, b)).when(o >= BLOCK - HALO, F.array(b, b + 1)).otherwise(F.array(b))
    f = f.withColumn("block", F.explode(blocks)).repartition("episode_idx", "block")
    f = f.sortWithinPartitions("episode_idx", "block", "frame_index", *[F.col(c).isNull() for c in fields])
    return materialize(f.mapInArrow(_measurer(tuple(fields), GRIPPERS if grippers is None else grippers, tuple(stops), TURNS if turns is None else turns, 8192), MEASURED), "spikes")


def pareto_cutoff(x: np.ndarray, n: np.ndarray, risk: float = RISK) -> float:
    """Cutoff from a histogram (``n`` residuals of size ``x``, ascending): a generalised Pareto law over the 95 % quantile.

    Its scale and shape come from the quantiles that halve the peaks and halve them again, so the highest quarter, which
    may be the spikes looked for, has no weight. The shape is 0 (exponential) unless the tail is heavier by more than
    twice the error of its estimate, about 4.4 over the root of the number of peaks. Where even the 99 % quantile is zero,
    the law is that of the residuals that are not; if those are fewer than ``SOME``, the cutoff is zero: whatever departs
    and returns is more than usual. NaN if all are zero.
    """
    c = np.cumsum(n)
    low = bin_top(_bins(x.astype(np.float32)) - 2)

    def q(p: float) -> float:
        k = min(int(np.searchsorted(c, p * c[-1])), len(c) - 1)
        return float(low[k] + (p * c[-1] - c[k] + n[k]) / n[k] * (x[k] - low[k]))

    u, half, quarter, q99 = q(1 - PEAKS), q(1 - PEAKS / 2), q(1 - PEAKS / 4), q(0.99)
    if q99 <= 0:
        moved = n[x > 0].sum()
        if moved < SOME:
            return 0.0 if moved else float("nan")
        return pareto_cutoff(x[x > 0], n[x > 0], min(risk * c[-1] / moved, PEAKS / 2))
    if half <= u:
        return u + (q99 - u) / np.log(PEAKS / 0.01) * np.log(PEAKS / risk)
    xi = float(np.log2(max(quarter - half, 1e-9) / (half - u))) - 2 * 4.4 / np.sqrt(PEAKS * c[-1])
    xi = float(np.clip(xi, 0.0, HEAVY))
    tail = PEAKS / risk
    return float(u + (half - u) * (np.log(tail) / np.log(2) if xi < 1e-3 else (tail**xi - 1) / (2**xi - 1)))


def run_cutoff(x: np.ndarray, n: np.ndarray, risk: float = RISK) -> float:
    """Length from which a run of equal readings has less than ``risk``, by the rate at which readings repeat in short runs."""
    short = x < SHORT_RUN
    p = (float(((x - 1) * n)[short].sum()) + 1) / (float((x * n)[short].sum()) + 2)
    return float(max(np.ceil(1 + np.log(risk) / np.log(p)), LEAST_RUN))


def _fitter(risk: float):
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                bins = sorted((int(c["x"]), c["n"]) for c in row.pop("cells"))
                x, n = np.array([k for k, _ in bins]), np.array([k for _, k in bins], float)
                if row["kind"] in ("inner", "edge"):
                    cut = pareto_cutoff(bin_top(x), n, risk)
                elif row["kind"] == "run":
                    cut = run_cutoff(x, n, risk)
                else:
                    cut = max(REACH_FLOOR, REACH * float(bin_top(x)[np.searchsorted(np.cumsum(n), 0.999 * n.sum())]))
                out.append({**row, "n": int(n.sum()), "cutoff": cut})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("kind", pa.string()), ("source", pa.string()), ("field", pa.string()), ("slot", pa.int64()), ("n", pa.int64()), ("cutoff", pa.float64())]))

    return fit


def cutoffs(measured: DataFrame, risk: float = RISK) -> DataFrame:
    """``kind, source, field, slot, n, cutoff``: the cutoffs of every source and slot; ``reach`` is that of all sources.

    A source with fewer than ``ENOUGH`` residuals in a slot, or with none but zeros, gets the cutoff of all sources; at the
    ends of episodes, its inner cutoff times what is usual between the two.
    """
    h = measured.filter("n is not null").groupBy("kind", "source", "field", "slot", "x").agg(F.sum("n").alias("n"))
    pooled = h.groupBy("kind", "field", "slot", "x").agg(F.sum("n").alias("n")).withColumn("source", F.lit("*"))
    both = h.filter("kind <> 'level'").withColumn("own", F.lit(True)).unionByName(pooled.withColumn("own", F.lit(False)))
    cells = both.groupBy("own", "kind", "source", "field", "slot").agg(F.collect_list(F.struct(F.col("x").cast("int").alias("x"), "n")).alias("cells"))
    fit = lambda own: cells.filter(F.col("own") == own).drop("own").mapInArrow(_fitter(risk), "kind string, source string, field string, slot long, n long, cutoff double")
    own, rest = materialize(fit(True), "fits"), fit(False)
    rest = rest.select("kind", "field", "slot", F.col("n").alias("n_all"), F.nanvl("cutoff", F.lit(None).cast("double")).alias("all_cutoff"))
    joined = own.join(small(rest), ["kind", "field", "slot"], "left")
    one = joined.select("kind", "source", "field", "slot", "n", F.when((F.col("n") >= ENOUGH) & ~F.isnan("cutoff"), F.col("cutoff")).otherwise(F.col("all_cutoff")).alias("cutoff"))
    few = (F.col("kind") == "edge") & (F.col("n") < ENOUGH)
    inner = one.filter("kind = 'inner'").select(F.col("source").alias("i_source"), F.col("field").alias("i_field"), F.col("slot").alias("i_slot"), F.col("cutoff").alias("i_cutoff"))
    same = F.col("source").eqNullSafe(F.col("i_source")) & (F.col("field") == F.col("i_field")) & (F.col("slot") == F.col("i_slot"))
    fitted = own.filter((F.col("kind") == "edge") & (F.col("n") >= SOME) & ~F.isnan("cutoff")).join(inner.filter("i_cutoff > 0"), same)
    ratio = fitted.groupBy("field", "slot").agg(F.median(F.col("cutoff") / F.col("i_cutoff")).alias("ratio"))
    ends = one.filter(few).join(inner, same, "left").join(ratio, ["field", "slot"], "left").withColumn("cutoff", F.coalesce(F.col("i_cutoff") * F.coalesce("ratio", F.lit(EDGE)), "cutoff"))
    columns = ["kind", "source", "field", "slot", "n", "cutoff"]
    one = one.filter(~few).select(*columns).unionByName(ends.select(*columns))
    level = rest.filter("kind = 'level'").select(F.lit("reach").alias("kind"), F.lit("*").alias("source"), "field", "slot", F.col("n_all").alias("n"), F.col("all_cutoff").alias("cutoff"))
    return one.unionByName(level)


def find_implausible(frames: DataFrame, source: str = "robot", risk: float = RISK, **how) -> DataFrame:
    """Implausible readings: ``episode_idx, frame_index, field, slot, reason`` (``spike``, ``stuck``, ``bad``, ``reach``); one row each and reason.

    A spike exceeds both its source's cutoff for the slot and ``LOCAL`` times what is typical of its own episode, and the
    level returns after it; at the ends of an episode, where that is not to be seen, a short departure counts as a spike.
    """
    m = measure(frames, source, **how)
    cut = small(materialize(cutoffs(m, risk).filter("cutoff is not null"), "cutoffs"))
    seen = m.filter("n is null")
    key = F.when(F.col("kind") == "reach", "*").otherwise(F.col("source"))
    seen = seen.withColumns({"source": key, "kind": F.rtrim(F.col("kind"), F.lit("?"))})
    c = cut.select(F.col("kind").alias("c_kind"), F.col("source").alias("c_source"), F.col("field").alias("c_field"), F.col("slot").alias("c_slot"), "cutoff")
    on = (F.col("kind") == F.col("c_kind")) & F.col("source").eqNullSafe(F.col("c_source")) & (F.col("field") == F.col("c_field")) & (F.col("slot") == F.col("c_slot"))
    over = F.when(F.col("kind") == "run", F.col("x") >= F.col("cutoff")).otherwise(F.col("x") > F.col("cutoff"))
    hit = seen.filter("kind <> 'bad'").join(c, on, "inner").filter(over).unionByName(seen.filter("kind = 'bad'"), allowMissingColumns=True)
    reason = F.when(F.col("kind").isin("inner", "edge"), "spike").when(F.col("kind") == "run", "stuck").otherwise(F.col("kind"))
    return hit.select("episode_idx", "frame_index", "field", "slot", reason.alias("reason")).distinct()
