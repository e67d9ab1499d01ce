"""Block scoring inside a task: one matrix product per Arrow batch.

A product in single precision screens the pairs, with a margin that covers its
rounding error; the few survivors are scored again in double precision, so the
result is exact and independent of how rows fall into batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PAIRS_PER_STEP = 1_000_000
# Bytes of vectors that are scored exactly in one step.
EXACT_BYTES = 64 * 1024 * 1024
# Bounds of a range hold up to the rounding error of a score, relative to the bound.
SLACK = 1e-14
# New candidates that are gathered before they are merged into the best k.
MERGE_AT = 20_000
# Groups whose highest entries give a bar: at least so many times k, and at most so many entries in each.
SPREAD, GROUPED = 8, 16


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as a (rows, dim) matrix, in the precision it is stored in."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        raise ValueError("vector column holds nulls")
    flat = column.flatten()
    if len(flat) != len(column) * dim or (np.diff(column.offsets.to_numpy()) != dim).any():
        raise ValueError(f"vector column holds vectors that are not {dim} long")
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), dim)


def squared_norms(rows: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", rows, rows, dtype=np.float64)


def id_values(column: pa.Array) -> np.ndarray:
    values = column.to_numpy(zero_copy_only=False)
    return values.astype(str) if values.dtype == object else values


def exact(metric: str, a: np.ndarray, b: np.ndarray, decimals: int | None = None, n: np.ndarray | None = None) -> np.ndarray:
    """Row-by-row scores of two equally long matrices, unrounded unless asked; NaN where undefined.

    ``n`` is the product of the lengths, where it is known.
    """
    a, b = a.astype(np.float64, copy=False), b.astype(np.float64, copy=False)
    if metric == "L2":
        d = a - b
        s = np.sqrt(np.einsum("ij,ij->i", d, d))
    else:
        s = np.einsum("ij,ij->i", a, b)
        if metric == "COSINE":
            n = _lengths(a) * _lengths(b) if n is None else n
            s = np.divide(s, n, out=np.full(len(s), np.nan), where=n > 0)
    return s if decimals is None else np.round(s, decimals)


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", rows, rows))


def exact_pairs(metric: str, a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, decimals: int | None, n=None) -> np.ndarray:
    """Scores of rows ``a[i]`` and ``b[j]``, gathered in steps of bounded size; ``n`` holds the lengths of both, where they are known."""
    step = max(1, EXACT_BYTES // (16 * max(1, a.shape[1])))
    with np.errstate(over="ignore", invalid="ignore"):
        known = lambda at, to: None if n is None else n[0][at] * n[1][to]
        cut = ((i[s : s + step], j[s : s + step]) for s in range(0, len(i), step))
        parts = [exact(metric, a[at], b[to], decimals, known(at, to)) for at, to in cut]
    return np.concatenate(parts) if parts else np.empty(0)


class Queries:
    """Query vectors prepared for screening; cosine screens with unit vectors."""

    def __init__(self, metric: str, ids: pa.Array, vectors: np.ndarray):
        self.metric = metric
        self.ids = ids
        # As they are stored: scores and products take them step by step in the precision they need.
        self.vectors = vectors
        self.squares = squared_norms(vectors)
        sound = np.isfinite(self.squares)
        self.weight = np.ones(len(vectors)) if metric == "COSINE" else np.where(sound, self.squares, 0.0)
        self.single = _fits_single(self.squares)
        # Queries without a score.
        self.void = ~sound | (self.squares == 0) if metric == "COSINE" else ~sound

    def left(self, pick: np.ndarray, kind: type) -> np.ndarray:
        """Some queries in the precision of the screening."""
        return _directions(self.metric, self.vectors[pick], self.squares[pick], kind)

    def __len__(self):
        return len(self.vectors)

    @property
    def dim(self) -> int:
        return self.vectors.shape[1]


def _directions(metric: str, rows: np.ndarray, squares: np.ndarray, kind: type) -> np.ndarray:
    """Rows as they are multiplied: for cosine unit vectors, computed in double precision."""
    if metric != "COSINE":
        return rows.astype(kind, copy=False)
    with np.errstate(invalid="ignore"):
        length = np.sqrt(squares)
        return (rows / np.where(length > 0, length, 1.0)[:, None]).astype(kind, copy=False)


def _fits_single(squares: np.ndarray) -> bool:
    """Whether products of vectors of these lengths neither overflow nor vanish in single precision."""
    some = squares[(squares > 0) & np.isfinite(squares)]
    return not len(some) or (some.max() < 1e30 and some.min() > 1e-30)


class Block:
    """Rows prepared for screening against several groups of queries."""

    def __init__(self, q: Queries, rows: np.ndarray):
        self.rows, self.double = rows, None
        self.squares = squared_norms(rows)
        self.kind = np.float32 if q.single and _fits_single(self.squares) else np.float64
        self.right = _directions(q.metric, rows, self.squares, self.kind).T
        eps = np.finfo(self.kind).eps
        self.error = 4.0 * (q.dim + 4) * float(eps)
        # Rows without a score.
        self.void = ~np.isfinite(self.squares) | ((q.metric == "COSINE") & (self.squares == 0))
        self.any_void = bool(self.void.any())
        sound = self.squares[np.isfinite(self.squares)]
        self.most = 1.0 if q.metric == "COSINE" else float(sound.max(initial=0.0))

    def screen(self, q: Queries, pick: np.ndarray, decimals: int | None):
        """Approximate gains (bigger is better) of some queries against the rows, and their margin."""
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            left = q.left(pick, self.kind)
            gain = (2 * left if q.metric == "L2" else left) @ self.right
            if q.metric == "L2":
                gain -= self.squares.astype(self.kind)[None, :]
                gain -= q.squares[pick].astype(self.kind)[:, None]
        # A row or query with NaN or infinite elements, or without a direction, has no score and displaces nothing.
        if self.any_void:
            gain[:, self.void] = -np.inf
        if q.void[pick].any():
            gain[q.void[pick]] = -np.inf
        # In proportion to the lengths, so that short vectors are told apart as well.
        size = q.weight[pick] + self.most
        margin = self.error * size + np.finfo(np.float64).tiny
        # Covers the rounding of scores as well, so that equal rounded scores are never cut apart.
        return gain, margin if decimals is None else margin + 8 * 10.0**-decimals * (1.0 + size)


    def scores(self, q: Queries, pick: np.ndarray, a: np.ndarray, b: np.ndarray, decimals: int | None) -> np.ndarray:
        """Exact scores of the queries ``pick[a]`` and the rows ``b``.

        Rows of a block are converted, and their lengths taken, once for all their pairs, unless they are too many bytes.
        """
        if not len(a) or max(self.rows.size, len(pick) * q.dim) * 16 > EXACT_BYTES:
            return exact_pairs(q.metric, q.vectors, pick[a], self.rows, b, decimals)
        some = q.vectors[pick].astype(np.float64)
        with np.errstate(over="ignore", invalid="ignore"):
            if self.double is None:
                double = self.rows.astype(np.float64)
                self.double = double, _lengths(double) if q.metric == "COSINE" else None
            rows, long = self.double
            n = (_lengths(some), long) if q.metric == "COSINE" else None
        return exact_pairs(q.metric, some, a, rows, b, decimals, n)


class Bounds:
    """A similarity range, also as bounds on the screening gain."""

    def __init__(self, metric: str, low: float = -np.inf, high: float = np.inf, slack: float = SLACK):
        self.metric = metric
        self.low = low - slack * abs(low) if np.isfinite(low) else low
        self.high = high + slack * abs(high) if np.isfinite(high) else high
        self.open = np.isneginf(low) and np.isposinf(high)
        if metric == "L2":  # similarity 1/(1+d), gain -d*d
            # A distance as a bound is known to a few digits less, the closer the similarity is to 1.
            far = lambda s, more: np.square(max(0.0, 1.0 / s - 1.0 + more * 4 * SLACK / s))
            self.least = -np.inf if low <= 0 else -far(low, 1)
            self.most = np.inf if high >= 1 else -np.inf if high <= 0 else -far(high, -1)
            self.sure = self.most if high >= 1 or high <= 0 else -far(high, 1)
        else:
            self.least, self.most, self.sure = self.low, self.high, high

    def keep(self, score: np.ndarray) -> np.ndarray:
        """Rows without a score count only where no range was asked for."""
        if self.open:
            return np.ones(len(score), bool)
        with np.errstate(invalid="ignore"):
            alike = 1.0 / (1.0 + score) if self.metric == "L2" else score
            return (alike >= self.low) & (alike <= self.high)


def _id_array(ids: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(ids.tolist() if ids.dtype.kind == "U" else ids).cast(kind)


class TopK:
    """Running best k of every query, within a similarity range, over the batches of one task.

    At most ``per_step`` queries are multiplied with rows at once.
    """

    def __init__(
        self, queries: Queries, k: int, decimals: int | None = None, low: float = -np.inf, high: float = np.inf, per_step: int | None = None
    ):
        self.q, self.k, self.decimals, self.per_step = queries, k, decimals, per_step or len(queries)
        self.bounds = Bounds(queries.metric, low, high, SLACK if decimals is None else 0.0)
        self.held = (np.empty(0, np.int64), np.empty(0), None)
        self.new, self.n_new = [], 0
        # Gain (in screening units) that a row must reach to matter to a query.
        self.floor = np.full(len(queries), self.bounds.least)
        # The k-th best row of each query so far, where it has one: gain and id.
        self.full, self.bar, self.bar_id = np.zeros(len(queries), bool), np.zeros(len(queries)), None

    def add(self, ids: np.ndarray, rows: np.ndarray, pick: np.ndarray | None = None):
        """Offer rows to all queries, or to the ones picked."""
        if not len(rows) or not len(self.q):
            return
        pick = np.arange(len(self.q)) if pick is None else pick
        block = Block(self.q, rows)
        step = max(1, min(PAIRS_PER_STEP // len(rows), self.per_step))
        # Of rows without a score, which rank last by their id, only the lowest k matter.
        undefined = block.void
        by_id = np.argsort(ids, kind="stable")
        low_undefined, low_any = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
        low_undefined[by_id[undefined[by_id]][: self.k]] = True
        low_any[by_id[: self.k]] = True
        cut = len(rows) - self.k
        for start in range(0, len(pick), step):
            part = pick[start : start + step]
            gain, margin = block.screen(self.q, part, self.decimals)
            floor = self.floor[part]
            near = self._near(gain, floor, margin)
            # Once the best so far set a bar few rows are above it; before, the rows themselves set one.
            if cut > 0 and np.count_nonzero(near) > 4 * self.k * len(part):
                sure = gain
                if np.isfinite(self.bounds.most):
                    # Only rows that are surely inside the range may raise the bar.
                    sure = np.where(gain <= (self.bounds.sure - margin)[:, None], gain, -np.inf)
                near = self._near(gain, np.maximum(floor, _reached(sure, self.k)), margin)
            mute = self.q.void[part]
            if block.any_void or mute.any() or block.kind is np.float64:
                near &= ~np.isneginf(gain) | np.where(mute[:, None], low_any[None, :], low_undefined[None, :])
            a, b = _places(near)
            value = block.scores(self.q, part, a, b, self.decimals)
            value = np.where(np.isfinite(value), value, np.nan)
            keep = self.bounds.keep(value)
            value = -value if self.q.metric == "L2" else value
            gains = np.where(np.isnan(value), -np.inf, value)
            if self.bar_id is not None:
                # Not better than the k-th so far: the crowd of rows that tie with it is not merged.
                at, bar = part[a], self.bar[part[a]]
                keep &= ~self.full[at] | (gains > bar) | ((gains == bar) & ~(ids[b] >= self.bar_id[at]))
            self.new.append((part[a][keep], gains[keep], ids[b][keep]))
            self.n_new += int(keep.sum())
        if self.n_new >= max(MERGE_AT, len(self.held[0]) // 2):
            self._merge()

    def _near(self, gain: np.ndarray, floor: np.ndarray, margin: np.ndarray) -> np.ndarray:
        """Which rows may reach the floor and lie inside the range."""
        near = gain >= _below(floor - margin, gain.dtype)[:, None]
        if np.isfinite(self.bounds.most):
            near &= gain <= (self.bounds.most + margin)[:, None]
        return near

    def _merge(self):
        parts = [p for p in [self.held, *self.new] if len(p[0])]
        self.new, self.n_new = [], 0
        if not parts:
            return
        qi, gain, ids = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((ids, -gain, qi))
        qi, gain, ids = qi[order], gain[order], ids[order]
        place = np.arange(len(qi)) - np.searchsorted(qi, qi, side="left")
        last = place == self.k - 1
        bar = gain[last]
        self.bar_id = np.zeros(len(self.q), ids.dtype)
        self.full[qi[last]], self.bar[qi[last]], self.bar_id[qi[last]] = True, bar, ids[last]
        # L2 is screened by its negative square.
        bar = -(bar * bar) if self.q.metric == "L2" else bar
        self.floor[qi[last]] = np.maximum(bar, self.bounds.least)
        keep = place < self.k
        self.held = (qi[keep], gain[keep], ids[keep])

    def table(self, id_type: pa.DataType) -> pa.Table | None:
        self._merge()
        qi, gain, ids = self.held
        if ids is None or not len(ids):
            return None
        value = -gain if self.q.metric == "L2" else gain
        value = value + 0.0  # no negative zero
        return pa.table(
            {
                "qid": self.q.ids.take(pa.array(qi)),
                "id": _id_array(ids, id_type),
                "score": pa.array(value, mask=~np.isfinite(value)),
            }
        )


def _places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of what is set, as ``np.nonzero`` gives them; one flat array is searched much faster."""
    return np.divmod(np.flatnonzero(mask), mask.shape[1])


def _reached(gain: np.ndarray, k: int) -> np.ndarray:
    """What at least ``k`` entries of each row reach: the k-th of the highest of groups of entries."""
    groups = max(SPREAD * k, gain.shape[1] // GROUPED)
    deep = gain.shape[1] // groups
    if deep > 1:
        # Entries that lie ``groups`` apart are one group, so whole stretches are compared at once; the rest is left out.
        gain = gain[:, : deep * groups].reshape(len(gain), deep, groups).max(axis=1)
    cut = gain.shape[1] - k
    return np.partition(gain, cut, axis=1)[:, cut]


def _below(values: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Values in the precision of the screening, none above what it was."""
    if kind != np.float32:
        return values
    with np.errstate(over="ignore"):
        return np.nextafter(values.astype(np.float32), np.float32(-np.inf))


def in_range(q: Queries, ids, rows, low: float, high: float, decimals: int | None, id_type, pick: np.ndarray | None = None, per_step: int | None = None) -> Iterator[pa.Table]:
    """All pairs whose similarity lies within [low, high], of all queries or of the ones picked."""
    bounds, block = Bounds(q.metric, low, high, SLACK if decimals is None else 0.0), Block(q, rows)
    pick = np.arange(len(q)) if pick is None else pick
    step = max(1, min(PAIRS_PER_STEP // max(1, len(rows)), per_step or len(q)))
    held, n = [], 0

    def table() -> pa.Table:
        i, j, value = (np.concatenate([h[c] for h in held]) for c in range(3))
        return pa.table({"qid": q.ids.take(pa.array(i)), "id": _id_array(ids[j], id_type), "score": pa.array(value + 0.0)})

    for start in range(0, len(pick), step):
        part = pick[start : start + step]
        gain, margin = block.screen(q, part, decimals)
        a, b = _places(gain >= _below(bounds.least - margin, gain.dtype)[:, None])
        inside = gain[a, b] <= (bounds.most + margin)[a]
        a, b = a[inside], b[inside]
        value = block.scores(q, part, a, b, decimals)
        keep = bounds.keep(value) & np.isfinite(value)
        if keep.any():
            held.append((part[a][keep], b[keep], value[keep]))
            n += len(held[-1][0])
        if n >= MERGE_AT:
            yield table()
            held, n = [], 0
    if held:
        yield table()
