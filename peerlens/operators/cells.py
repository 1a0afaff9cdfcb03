"""Nearest and farthest k of many rows in few dimensions: cells with boxes, and only cells that can matter.

A sample's medians cut the rows of each pattern of presence into cells of some
``CELL_ROWS`` rows; a cell's box is that of its rows.  Between a row and a box
lies a least and a largest distance, over the coordinates both have and scaled
as the distances are.

Nearest: each row is compared inside its own cell, which bounds its k-th best,
and then goes to every other cell whose box is within that bound.  Rows of
rarer patterns first go to one cell of a common one, as few of their own kind
lie near them.

Farthest: rows that are farthest from some witnesses give every row a bound that
is nearly its k-th best.  A row is sent to the cells whose rows it can be that
far away from: by their box, and by the triangle inequality around the middle
of all rows.  Only few rows on the outside are ever sent.

Inside a task hosts lie in leaves of some ``LEAF_ROWS`` rows with boxes of their
own, and a guest is compared with the leaves that can hold one of its k best.
Bounds are on the safe side and what is ranked is computed from plain
differences, so the lists are those of the full comparison, ties by key included.

Rows that share no coordinate have no distance and are told by key alone: of each
pattern the first and last keys suffice.  Of copies of a vector only the first
and last k + 1 can be in a list; the others get the lists of one of these.

What reaches the driver: a sample of ``PER_CELL`` rows a cell, a row a cell, and
the witnesses' farthest rows.  A task holds two cells or parts of such size.
"""

import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerlens.operators.blocks import MAX_BLOCK_ROWS, MAX_TASKS, _one_chunk, exact_distances
from peerlens.sources.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_WIDTH = 8  # at most 256 patterns of presence; in more dimensions boxes rule out little
CELL_ROWS = 16384
LEAF_ROWS = 128
PER_CELL = 32  # sample rows a cell
MAX_SAMPLE = 1 << 20
WITNESSES = 256
MAX_OUTER = 2048  # rows that give the bounds of the farthest
CELLS = 1 << 19  # cells of one distance or bound tile
CHUNK_ROWS = 8192  # guests searched at a time
FIRST_LEAVES = 3
SLACK = 1e-9  # relative; bounds of vectors of eight coordinates are off by some 1e-15
RANK = 2e-9  # ranks have nine decimals


@dataclass(frozen=True)
class Tree:
    """Cuts of all patterns: a child below zero is the complement of a cell's number."""

    roots: dict[int, int]
    dim: np.ndarray
    cut: np.ndarray
    below: np.ndarray
    above: np.ndarray
    cells: int


@dataclass(frozen=True)
class Boxes:
    """The box of each cell, its pattern and its rows."""

    low: np.ndarray
    high: np.ndarray
    present: np.ndarray
    rows: np.ndarray

    @property
    def codes(self) -> np.ndarray:
        return pattern_codes(self.present)


class Rows:
    """Keys and vectors of one side, in the order of the keys; a missing key stands where it comes last among equal distances."""

    def __init__(self, table: pa.Table, farthest: bool):
        nulls = "at_start" if farthest else "at_end"
        table = table.take(pc.sort_indices(table, sort_keys=[("key", "ascending")], null_placement=nulls))
        self.table, self.keys, self.raw = table, _one_chunk(table.column("key")), matrix(table)


def matrix(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    vec = _one_chunk(table.column("vec"))
    flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(vec), len(flat) // max(len(vec), 1))


def pattern_codes(present: np.ndarray) -> np.ndarray:
    """A number for each pattern of presence: bit i for coordinate i."""
    return present.astype(np.int64) @ (1 << np.arange(present.shape[1]))


def slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that rows times ``width`` stay bounded."""
    step = max(1, CELLS // max(width, 1))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def cut_of(rows: np.ndarray, dims: np.ndarray) -> tuple[int, float] | None:
    """The widest coordinate and a value near its median with rows on both sides; none if all rows are alike."""
    if len(rows) < 2 or not len(dims):
        return None
    spread = rows[:, dims].std(axis=0)
    spread[rows[:, dims].max(axis=0) == rows[:, dims].min(axis=0)] = -1
    dim = int(dims[np.nan_to_num(spread, nan=0.0).argmax()])
    values = rows[:, dim]
    cut = np.partition(values, len(values) // 2)[len(values) // 2]
    if cut <= values.min():
        cut = values[values > cut].min(initial=np.inf)
    return (dim, float(cut)) if (values < cut).any() and (values >= cut).any() else None


def plant(sample: np.ndarray, codes: Sequence[int], every: int, cell_rows: int) -> Tree:
    """Cuts each pattern's sample at medians until a cell stands for ``cell_rows`` rows at most."""
    nodes, roots, cells = [], {}, 0
    sampled = pattern_codes(~np.isnan(sample))
    for code in codes:
        dims = np.flatnonzero(code >> np.arange(sample.shape[1]) & 1)
        work = [(sample[sampled == code], None)]
        while work:
            rows, parent = work.pop()
            found = cut_of(rows, dims) if len(rows) * every > cell_rows else None
            if found:
                at = len(nodes)
                nodes.append([*found, 0, 0])
                work += [(rows[rows[:, found[0]] < found[1]], (at, 2)), (rows[rows[:, found[0]] >= found[1]], (at, 3))]
            else:
                at, cells = ~cells, cells + 1
            if parent:
                nodes[parent[0]][parent[1]] = at
            else:
                roots[code] = at
    dim, cut, below, above = (np.array([n[i] for n in nodes], float if i == 1 else np.int64) for i in range(4))
    return Tree(roots, dim, cut, below, above, cells)


def to_cells(tree: Tree) -> Callable:
    """Adds the cell of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = matrix(batch)
            codes = pattern_codes(~np.isnan(raw))
            at = np.zeros(len(raw), np.int64)
            for code in np.unique(codes):
                at[codes == code] = tree.roots[int(code)]
            while len(rows := np.flatnonzero(at >= 0)):
                node = at[rows]
                at[rows] = np.where(raw[rows, tree.dim[node]] < tree.cut[node], tree.below[node], tree.above[node])
            columns = [batch.column("key"), batch.column("vec"), pa.array((~at).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "vec", "cell"])

    return run


def box_bounds(raw: np.ndarray, code: int, low: np.ndarray, high: np.ndarray, present: np.ndarray, farthest: bool) -> np.ndarray:
    """Of rows of one pattern to boxes: the least or the largest distance, rounding aside; NaN if no coordinate is shared."""
    p = raw.shape[1]
    shared = np.flatnonzero(code >> np.arange(p) & 1)
    total = np.zeros((len(raw), len(low)))
    with np.errstate(invalid="ignore"):
        for i in shared:
            x, here = raw[:, i, None], present[:, i]
            a, b = np.where(here, low[:, i], 0.0), np.where(here, high[:, i], 0.0)
            gap = np.maximum(np.abs(x - a), np.abs(x - b)) if farthest else np.maximum(np.maximum(a - x, x - b), 0.0)
            gap *= gap
            gap *= here
            total += gap
    used = present[:, shared].sum(axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.sqrt(np.where(used > 0, total * (p / np.maximum(used, 1)), np.nan))


def leaves_of(raw: np.ndarray, rows: np.ndarray, dims: np.ndarray) -> list[np.ndarray]:
    """Rows as runs of ``LEAF_ROWS`` at most, cut at medians; rows all alike stay together."""
    work, out = [rows], []
    while work:
        some = work.pop()
        found = cut_of(raw[some], dims) if len(some) > LEAF_ROWS else None
        if not found:
            out.append(some)
            continue
        left = raw[some, found[0]] < found[1]
        work += [some[~left], some[left]]
    return out


def best_of(found: list, limit: np.ndarray, k: int, farthest: bool) -> tuple[list, np.ndarray]:
    """The k best ``(row, column, distance, rank)`` of each row, and the limits that follow from them."""
    if not found:
        return [], limit
    r, c, d, rank = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((-c, -rank, r) if farthest else (c, rank, r))
    r, c, d, rank = r[order], c[order], d[order], rank[order]
    place = np.arange(len(r)) - np.searchsorted(r, r, side="left")
    last, limit = place == k - 1, limit.copy()
    limit[r[last]] = (np.maximum if farthest else np.minimum)(limit[r[last]], rank[last])
    kept = place < k
    return [(r[kept], c[kept], d[kept], rank[kept])], limit


def search(
    a: Rows, b: Rows, own: np.ndarray, limit: np.ndarray, k: int, farthest: bool
) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """Of the k best rows of ``b`` for each row of ``a`` those that reach its limit: (rows, columns, distances), and new limits.

    ``own`` names a row's place in ``b``.  Pairs without a distance are left out.
    """
    p = a.raw.shape[1]
    here_b = ~np.isnan(b.raw)
    codes_a, codes_b = pattern_codes(~np.isnan(a.raw)), pattern_codes(here_b)
    hosts = {}
    for code in np.unique(codes_b):
        dims = np.flatnonzero(code >> np.arange(p) & 1)
        leaves = leaves_of(b.raw, np.flatnonzero(codes_b == code), dims)
        low, high = (np.array([f(b.raw[x], axis=0) for x in leaves]) for f in (np.min, np.max))
        hosts[int(code)] = leaves, low, high
    out, limit = [], limit.copy()
    for code in np.unique(codes_a):
        rows = np.flatnonzero(codes_a == code)
        for start in range(0, len(rows), CHUNK_ROWS):
            chunk = rows[start : start + CHUNK_ROWS]
            found, limit[chunk] = _search_chunk(a, chunk, int(code), b, hosts, own, limit[chunk], k, farthest)
            out += found
    r, c, d = (np.concatenate([x[i] for x in out]) if out else np.zeros(0, float if i == 2 else np.int64) for i in range(3))
    return (r, c, d), limit


def _search_chunk(a: Rows, chunk: np.ndarray, code: int, b: Rows, hosts: dict, own: np.ndarray, limit: np.ndarray, k: int, farthest: bool):
    p = a.raw.shape[1]
    raw, mine = a.raw[chunk], own[chunk]
    found, held = [], 0

    def compare(side: tuple, index: np.ndarray, rows: np.ndarray) -> None:
        nonlocal held
        left, right, norm, largest, scale, dims = side
        host = right[index]
        for start in range(0, len(rows), step := max(1, CELLS // len(index))):
            some = rows[start : start + step]
            v = left[some] @ host.T
            error = 8.0 * (2 * len(dims) + 8) * np.finfo(float).eps * (norm[some] + largest)
            reach = limit[some]
            open_ = ~np.isfinite(reach)
            if open_.any() and len(index) > k:  # the row itself can be among them, so one more
                w = -v[open_] if farthest else v[open_]
                edge = np.partition(w, k, axis=1)[:, k]
                if farthest:
                    reach[open_] = np.sqrt(np.maximum(-edge - error[open_], 0.0) * scale) - RANK
                else:
                    reach[open_] = np.sqrt(np.maximum(edge + error[open_], 0.0) * scale) + RANK
                limit[some] = reach
            if farthest:
                least = np.maximum(reach - RANK, 0.0)
                r, c = np.divmod(np.flatnonzero(v >= np.where(least > 0, least**2 / scale - error, -np.inf)[:, None]), len(index))
            else:
                r, c = np.divmod(np.flatnonzero(v <= ((np.maximum(reach, 0.0) + RANK) ** 2 / scale + error)[:, None]), len(index))
            r, c = some[r], index[c]
            others = c != mine[r]
            r, c = r[others], c[others]
            d = exact_distances(a, chunk[r], b, c)
            rank = np.round(d, 9)
            found.append((r, c, d, rank))
            held += len(r)

    sides, bounds = [], []
    for host_code, (leaves, low, high) in hosts.items():
        dims = np.flatnonzero((code & host_code) >> np.arange(p) & 1)
        if not len(dims):
            continue
        every = np.concatenate(leaves)
        shift = b.raw[every][:, dims].mean(axis=0)
        x, y = raw[:, dims] - shift, b.raw[:, dims] - shift
        norm, norm_b = (x * x).sum(axis=1), (y * y).sum(axis=1)
        left = np.hstack([-2.0 * x, norm[:, None], np.ones((len(x), 1))])
        right = np.hstack([y, np.ones((len(y), 1)), norm_b[:, None]])
        side = left, right, norm, norm_b[every].max(), p / len(dims), dims
        sides += [(side, index) for index in leaves]
        present = np.broadcast_to((host_code >> np.arange(p) & 1).astype(bool), low.shape)
        bounds.append(box_bounds(raw, code, low, high, present, farthest))
    if not sides:
        return [], limit
    bound = np.hstack(bounds)
    bound *= 1 + SLACK if farthest else 1 - SLACK
    some = min(FIRST_LEAVES, bound.shape[1])
    first = np.zeros(bound.shape, bool)
    if farthest or not np.isfinite(limit).all():
        best = np.argpartition(-bound if farthest else bound, some - 1, axis=1)[:, :some]
        first[np.arange(len(bound))[:, None], best] = True
    for planned in (first, ~first):
        for j, (side, index) in enumerate(sides):
            if farthest:
                go = planned[:, j] & ~(bound[:, j] < limit - RANK)
            else:
                go = planned[:, j] & ~(bound[:, j] > limit + RANK)
            if len(rows := np.flatnonzero(go)):
                compare(side, index, rows)
            if held > CELLS:
                found, limit = best_of(found, limit, k, farthest)
                held = 0
        found, limit = best_of(found, limit, k, farthest)
        held = 0
    return [(chunk[r], c, d) for r, c, d, rank in found], limit


def packed(r: np.ndarray, n: int, values: Sequence[pa.Array]) -> list[pa.Array]:
    """Values as one list a row; ``r``, the row of each, goes up."""
    ends = pa.array(np.searchsorted(r, np.arange(n + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(ends, x) for x in values]


def lists_of(a: Rows, b: Rows, found: tuple, n: int) -> list[pa.Array]:
    r, c, d = found
    order = np.argsort(r, kind="stable")
    return packed(r[order], n, [b.keys.take(pa.array(c[order])), pa.array(d[order])])


def own_lists(k: int) -> Callable:
    """Group function: a cell's rows with the k nearest inside and their limits."""

    def run(table: pa.Table) -> pa.Table:
        a = Rows(table, False)
        n = len(a.raw)
        found, limit = search(a, a, np.arange(n), np.full(n, np.inf), k, False)
        columns = [a.keys, a.table.column("vec"), a.table.column("cell"), pa.array(limit), *lists_of(a, a, found, n)]
        return pa.Table.from_arrays(columns, names=["key", "vec", "cell", "bound", "dest", "distance"])

    return run


def guest_lists(k: int, farthest: bool) -> Callable:
    """Group function: of the hosts the k best for each guest that reach its bound, the bound they give, and a host's cell."""

    def run(table: pa.Table) -> pa.Table:
        host = _one_chunk(table.column("host"))
        a, b = Rows(table.filter(pc.invert(host)), farthest), Rows(table.filter(host), farthest)
        n, limit = len(a.raw), a.table.column("bound").to_numpy()
        found, met = tuple(np.zeros(0, t) for t in (np.int64, np.int64, float)), None
        if n and len(b.raw):
            own = pc.fill_null(pc.index_in(a.keys, b.keys), -1).to_numpy()
            found, limit = search(a, b, own, limit, k, farthest)
            met = b.table.column("cell")[0].as_py()
        columns = [a.keys, pa.array([met] * n, pa.int32()), pa.array(limit), *lists_of(a, b, found, n)]
        return pa.Table.from_arrays(columns, names=["key", "met", "bound", "dest", "distance"])

    return run


def near_visits(boxes: Boxes, partner: dict[int, int], number: int) -> Callable:
    """Which cells a row must go to after its own: in round 1 one of a common pattern, in round 2 all others.

    Yields each batch with the rows' and the cells' positions.
    """
    codes = boxes.codes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        for batch in slices(batches, len(codes)):
            raw, cell = matrix(batch), batch.column("cell").to_numpy()
            limit = batch.column("bound").to_numpy()
            seen = batch.column("seen").to_numpy() if number == 2 else None
            go = np.zeros((len(raw), len(codes)), bool)
            own = codes[cell]
            for code in np.unique(own):
                rows = np.flatnonzero(own == code)
                bound = box_bounds(raw[rows], int(code), boxes.low, boxes.high, boxes.present, False) * (1 - SLACK)
                with np.errstate(invalid="ignore"):
                    within = bound <= (limit[rows] + RANK)[:, None]
                within[:, boxes.rows == 0] = False
                within[np.arange(len(rows)), cell[rows]] = False
                if number == 2:
                    some = np.flatnonzero(seen[rows] >= 0)
                    within[some, seen[rows][some]] = False
                elif int(code) in partner:
                    bound[:, codes != partner[int(code)]] = np.nan
                    bound[:, boxes.rows == 0] = np.nan
                    bound = np.where(np.isnan(bound), np.inf, bound)
                    # Among boxes around the row, the one whose middle is near.
                    middle = box_bounds(raw[rows], int(code), *[(boxes.low + boxes.high) / 2] * 2, boxes.present, False)
                    best = (bound + 1e-6 * np.nan_to_num(middle)).argmin(axis=1)
                    one = np.zeros(within.shape, bool)
                    one[np.arange(len(rows)), best] = True
                    within &= one
                else:
                    within[:] = False
                go[rows] = within
            yield batch, *np.nonzero(go)

    return run


def scaled_squares(raw: np.ndarray, others: np.ndarray, middle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances, -inf where there are none, and how far off they may be."""
    here, there = ~np.isnan(raw), ~np.isnan(others)
    x, y = np.where(here, raw - middle, 0.0), np.where(there, others - middle, 0.0)
    total = (x * x) @ there.T.astype(float) + here.astype(float) @ (y * y).T - 2.0 * x @ y.T
    used = here.astype(float) @ there.T.astype(float)
    p = raw.shape[1]
    error = 8.0 * (2 * p + 8) * np.finfo(float).eps * p * ((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :])
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(used > 0.5, total * p / used, -np.inf), error


def farthest_rows(raw: np.ndarray, witnesses: np.ndarray, middle: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of some rows those among the k farthest of a witness, and each witness's k-th squared distance."""
    v, _ = scaled_squares(witnesses, raw, middle)
    want = min(k, len(raw))
    best = np.argpartition(-v, want - 1, axis=1)[:, :want]
    reach = np.take_along_axis(v, best, axis=1)
    edge = reach.min(axis=1, initial=np.inf) if want == k else np.full(len(witnesses), -np.inf)
    return raw[np.unique(best[np.isfinite(reach)])], edge


def outer_rows(witnesses: np.ndarray, middle: np.ndarray, k: int) -> Callable:
    """The vectors of a task that are among its k farthest of a witness."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, edge = np.zeros((0, len(middle))), np.full(len(witnesses), -np.inf)
        for batch in slices(batches, len(witnesses)):
            raw = matrix(batch)
            v, _ = scaled_squares(witnesses, raw, middle)
            new = raw[(v > edge[:, None]).any(axis=0)]
            if len(new):
                held, edge = farthest_rows(np.concatenate([held, new]), witnesses, middle, k)
        ends = pa.array(np.arange(0, held.size + 1, held.shape[1]), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(held.ravel()))], names=["vec"])

    return run


def far_bounds(outer: np.ndarray, middle: np.ndarray, raw: np.ndarray, k: int) -> np.ndarray:
    """No more than the rank of each row's k-th farthest; -inf where too few outer rows share a coordinate with it."""
    if len(outer) < k:
        return np.full(len(raw), -np.inf)
    v, error = scaled_squares(raw, outer, middle)
    v -= error
    edge = -np.partition(-v, k - 1, axis=1)[:, k - 1]
    return np.where(np.isfinite(edge), np.sqrt(np.maximum(edge, 0.0)) - RANK, -np.inf)


def from_middle(raw: np.ndarray, middle: np.ndarray, code: int) -> tuple[np.ndarray, int]:
    """Distances to the middle over a pattern's coordinates, as far as rows have them."""
    some = np.flatnonzero(code >> np.arange(raw.shape[1]) & 1)
    return np.sqrt(((raw[:, some] - middle[some]) ** 2).sum(axis=1)), len(some)


def far_limits(boxes: Boxes, host_codes: Sequence[int], outer: np.ndarray, middle: np.ndarray, k: int) -> Callable:
    """For each cell and pattern of hosts: the least bound of its rows, and how far from the middle a host must be."""
    codes = boxes.codes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(outer)):
            raw, cell = matrix(batch), batch.column("cell").to_numpy()
            bound = far_bounds(outer, middle, raw, k)
            rows = []
            for one in np.unique(cell):
                mine = np.flatnonzero(cell == one)
                for host in host_codes:
                    if shared := int(codes[one]) & host:
                        off, used = from_middle(raw[mine], middle, shared)
                        need = (bound[mine] / math.sqrt(raw.shape[1] / used) - off * (1 + SLACK)).min()
                        rows.append((int(one), host, float(bound[mine].min()), float(need)))
            columns = [pa.array(list(x), t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.float64(), pa.float64()))]
            if rows:
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "code", "bound", "need"])

    return run


def far_visits(boxes: Boxes, least: np.ndarray, need: dict[int, np.ndarray], middle: np.ndarray) -> Callable:
    """Which cells a row can be among the farthest of; yields each batch with the rows' and the cells' positions."""
    codes = boxes.codes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        for batch in slices(batches, len(codes)):
            raw, own = matrix(batch), codes[batch.column("cell").to_numpy()]
            at_row, at_cell = [], []
            for code in np.unique(own):
                rows = np.flatnonzero(own == code)
                can = np.zeros((len(rows), len(codes)), bool)
                for shared in np.unique(codes & code):
                    if shared:
                        some = np.flatnonzero(codes & code == shared)
                        off, _ = from_middle(raw[rows], middle, int(shared))
                        can[:, some] = ~((off * (1 + SLACK) + RANK)[:, None] < need[int(code)][some][None, :])
                can[:, boxes.rows == 0] = False
                kept = np.flatnonzero(can.any(axis=1))
                high = box_bounds(raw[rows[kept]], int(code), boxes.low, boxes.high, boxes.present, True)
                r, c = np.nonzero(can[kept] & ~(high * (1 + SLACK) + RANK < least[None, :]))
                at_row.append(rows[kept][r])
                at_cell.append(c)
            none = [np.zeros(0, np.int64)]
            yield batch, np.concatenate(at_row or none), np.concatenate(at_cell or none)

    return run


def counted(visits: Callable, cells: int) -> Callable:
    """Only the numbers of rows that go to each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for _, _, at in visits(batches):
            total += np.bincount(at, minlength=cells)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["to", "rows"])

    return run


def sent(visits: Callable, bounded: bool) -> Callable:
    """The rows, once for each cell that they go to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, at in visits(batches):
            for start in range(0, len(row), CELLS // 8):
                some = pa.array(row[start : start + CELLS // 8])
                bound = batch.column("bound").take(some) if bounded else pa.nulls(len(some), pa.float64())
                columns = [*(batch.column(c).take(some) for c in ("key", "vec", "cell")), bound]
                to = pa.array(at[start : start + CELLS // 8].astype(np.int32))
                yield pa.RecordBatch.from_arrays([*columns, to], names=["key", "vec", "cell", "bound", "to"])

    return run


def undefined(codes: np.ndarray, near: dict[int, pa.Array], far: dict[int, pa.Array], wanted: Sequence[str]) -> Callable:
    """Lists of the first and last rows that share no coordinate with a row, by its cell's pattern."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = codes[batch.column("cell").to_numpy()]
            for code in np.unique(own):
                rows = np.flatnonzero(own == code)
                for which, keys in (("nearest", near), ("farthest", far)):
                    if which in wanted and int(code) in keys:
                        some = keys[int(code)]
                        index = pa.array(np.tile(np.arange(len(some)), len(rows)))
                        ends = pa.array(np.arange(0, len(index) + 1, len(some)), pa.int32())
                        dest = pa.ListArray.from_arrays(ends, some.take(index))
                        distance = pa.ListArray.from_arrays(ends, pa.nulls(len(index), pa.float64()))
                        columns = [pa.array([which == "farthest"] * len(rows)), batch.column("key").take(pa.array(rows)), dest, distance]
                        yield pa.RecordBatch.from_arrays(columns, names=["far", "key", "dest", "distance"])

    return run


def merged(k: int) -> Callable:
    """Group function: of all partial lists of some rows the k first of each, with their places."""

    def run(table: pa.Table) -> pa.Table:
        keys = _one_chunk(_one_chunk(table.column("key")).dictionary_encode(null_encoding="encode"))
        dest, distance = _one_chunk(table.column("dest")), _one_chunk(table.column("distance"))
        lengths = pc.list_value_length(dest).to_numpy()
        far = np.repeat(table.column("far").to_numpy(), lengths)
        orig = np.repeat(keys.indices.to_numpy(), lengths)
        dest, distance = dest.flatten(), distance.flatten()
        itself = keys.dictionary.take(pa.array(orig))
        alike = pc.or_(pc.fill_null(pc.equal(itself, dest), False), pc.and_(itself.is_null(), dest.is_null()))
        index = np.flatnonzero(~alike.to_numpy(zero_copy_only=False))
        d = distance.to_numpy(zero_copy_only=False)[index]
        reach = np.where(np.isnan(d), np.inf, np.round(d, 9))
        far, orig = far[index], orig[index].astype(np.int64)
        reach, group = np.where(far, -reach, reach), orig * 2 + far
        order = np.lexsort((reach, group))
        alike = (group[order][1:] == group[order][:-1]) & (reach[order][1:] == reach[order][:-1])
        lost, turn = dest.is_null().to_numpy(zero_copy_only=False)[index], np.zeros(len(index), np.int64)
        if alike.any():
            tied = order[np.append(alike, False) | np.insert(alike, 0, False)]
            rank = pc.rank(dest.take(pa.array(index[tied])), "ascending", null_placement="at_end", tiebreaker="dense")
            turn[tied] = np.where(far[tied], -1, 1) * rank.to_numpy().astype(np.int64)
            turn[lost] = len(index) + 1
            order = np.lexsort((turn, reach, group))
        sorted_group = group[order]
        place = np.arange(len(order)) - np.searchsorted(sorted_group, sorted_group, side="left") + 1
        order, place = order[place <= k], place[place <= k]
        if lost[order].any():  # a missing key that is among the nearest k is placed as Spark sorts it
            turn[lost & ~far] = -1
            order = order[np.lexsort((turn[order], reach[order], group[order]))]
        lists = pa.DictionaryArray.from_arrays(pa.array(far[order].astype(np.int8)), pa.array(["nearest", "farthest"])).cast(pa.string())
        columns = [lists, keys.dictionary.take(pa.array(orig[order])), dest.take(pa.array(index[order]))]
        columns += [pa.array(d[order], from_pandas=True), pa.array(place.astype(np.int32))]
        return pa.Table.from_arrays(columns, names=["list", "orig", "dest", "distance", "place"])

    return run


def _number(rows: dict[int, int], most_rows: int) -> tuple[list[tuple[int, int, int]], int]:
    """(cell, first group, groups) for cells that so many rows go to, and the number of groups."""
    out, at = [], 0
    for cell, n in sorted(rows.items()):
        out.append((cell, at, math.ceil(n / most_rows)))
        at += out[-1][2]
    return out, at


def _grouped(both: DataFrame, groups: int) -> DataFrame:
    """One partition a group: a group is long work on few bytes."""
    return both.repartitionById(min(groups, MAX_TASKS), F.col("group")).groupBy("group")


def _met(table: DataFrame, others: DataFrame, visits: Callable, cells: int, max_rows: int, going_host: bool) -> tuple[DataFrame | None, int]:
    """Rows of ``table`` where they go, as groups of bounded size with the rows of ``others`` there."""
    spark, kind = table.sparkSession, table.schema["key"].dataType.simpleString()
    counts = table.mapInArrow(counted(visits, cells), "to int, rows long").groupBy("to").agg(F.sum("rows").alias("rows")).collect()
    numbers, groups = _number({r.to: r.rows for r in counts}, max_rows)
    if not groups:
        return None, 0
    sites = F.broadcast(spark.createDataFrame(numbers, "to int, first int, parts int"))
    columns = f"key {kind}, vec array<double>, cell int, bound double"
    part = F.pmod(F.xxhash64("key", F.lit(2)), F.col("parts")).cast("int")
    going = table.mapInArrow(sent(visits, not going_host), f"{columns}, to int").join(sites, "to")
    going = going.select((F.col("first") + part).alias("group"), F.lit(going_host).alias("host"), "key", "vec", "cell", "bound")
    staying = others.join(sites, others["cell"] == F.col("to")).withColumn(
        "group", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1))
    )
    staying = staying.select("group", F.lit(not going_host).alias("host"), "key", "vec", "cell", "bound")
    return going.unionByName(staying), groups


def _copies_apart(vectors: DataFrame, k: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Rows that can be in a list; the other copies of their vectors; and for each such vector the keys whose lists these have.

    Of more than 2(k + 1) copies, ties by key put the k + 1 first or last ahead
    of all others.  The last copy is then in no nearest list of another one, so
    that list is the same for it and for all others between; for the farthest
    the first copy is such a one.
    """
    marked = vectors.withColumn("hash", F.when(F.col("key").isNotNull(), F.xxhash64("vec")))  # a missing key is always compared
    hashes = stage(marked.groupBy("hash").count().where(F.col("count") > 2 * (k + 1)).select("hash"), "copies")
    if hashes.isEmpty():
        return vectors, None, None
    repeated = stage(marked.join(hashes, "hash", "left_semi").drop("hash"), "copies")
    by_key = lambda order: Window.partitionBy("vec").orderBy(order)
    first, last = (
        repeated.withColumn("at", F.row_number().over(by_key(order))).where(F.col("at") <= k + 1).drop("at")
        for order in (F.col("key").asc(), F.col("key").desc())
    )
    ends = first.groupBy("vec").agg(F.max("key").alias("a"), F.min("key").alias("first")).join(
        last.groupBy("vec").agg(F.min("key").alias("b"), F.max("key").alias("last")), "vec"
    )
    ends = stage(ends, "copies")
    kept = first.unionByName(last).dropDuplicates(["key"])
    points = marked.join(hashes, "hash", "left_anti").drop("hash").unionByName(kept)
    others = repeated.join(ends, "vec").where((F.col("key") > F.col("a")) & (F.col("key") < F.col("b"))).select("key", "vec")
    return points, others, ends.select("vec", "first", "last")


def _partners(counts: dict[int, int]) -> dict[int, int]:
    """For a pattern the most common one that shares coordinates with it, if there is a more common one."""
    out = {}
    for code, n in counts.items():
        more = [(m, c) for c, m in counts.items() if c & code and m > n]
        if more:
            out[code] = max(more)[1]
    return out


def cell_lists(
    vectors: DataFrame, k: int, wanted: Sequence[str], cell_rows: int = CELL_ROWS, max_rows: int = MAX_BLOCK_ROWS
) -> DataFrame:
    """``(list, orig, dest, distance, place)`` of the stored ``vectors(key, vec)``: the k first of each row."""
    spark = vectors.sparkSession
    kind = vectors.schema["key"].dataType.simpleString()
    size = F.size("vec")
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.count("vec").alias("whole"), F.min(size).alias("low"), F.max(size).alias("high")).first()
    columns = f"list string, orig {kind}, dest {kind}, distance double, place int"
    if not shape.n:
        return spark.createDataFrame([], columns)
    if shape.n != shape.whole or shape.low != shape.high:
        raise ValueError("feature vectors differ in length")
    if not vectors.groupBy("key").count().where(F.col("count") > 1).isEmpty():
        raise ValueError("organisation keys are not unique")
    points, others, ends = _copies_apart(vectors, k)
    if others is not None:
        points = stage(points, "points")

    width = shape.low
    bits = [F.when(F.col("vec")[i].isNotNull() & ~F.isnan(F.col("vec")[i]), 1 << i).otherwise(0) for i in range(width)]
    coded = points.withColumn("code", sum(bits, F.lit(0)))
    counts = {r.code: r["count"] for r in coded.groupBy("code").count().collect()}
    rows = sum(counts.values())
    by_key = lambda order: Window.partitionBy("code").orderBy(order)
    edges = []  # of each pattern the first and the last rows by key
    for order in (F.col("key").asc_nulls_last(), F.col("key").desc_nulls_last()):
        edge = coded.withColumn("at", F.row_number().over(by_key(order))).where(F.col("at") <= k + 1)
        edges.append(edge.select("code", "key", "vec").toArrow())
    every = max(1, cell_rows // PER_CELL, rows // MAX_SAMPLE)
    drawn = matrix(points.where(F.pmod(F.xxhash64("key", F.lit(3)), F.lit(every)) == 0).select("vec").toArrow()).reshape(-1, width)
    tree = plant(drawn, sorted(counts), every, cell_rows)
    dealt = stage(points.mapInArrow(to_cells(tree), f"key {kind}, vec array<double>, cell int"), "cells")
    boxes = _boxes(dealt, tree, width)

    parts = []
    if "nearest" in wanted:
        parts += _nearest(dealt, boxes, _partners(counts), k, max_rows)
    if "farthest" in wanted:
        some = [x for edge in edges for x in _few_of_each(edge, max(1, WITNESSES // max(len(counts), 1)))]
        witnesses = np.concatenate([drawn[:WITNESSES], *some])
        parts += _farthest(dealt, boxes, sorted(counts), drawn, witnesses, k, max_rows)
    apart = [_apart(edge, counts, k, order) for edge, order in zip(edges, ("ascending", "descending"))]
    if any(apart):
        parts.append(
            dealt.mapInArrow(undefined(boxes.codes, *apart, wanted), f"far boolean, key {kind}, dest array<{kind}>, distance array<double>")
        )
    if not parts:
        return spark.createDataFrame([], columns)
    buckets = max(1, math.ceil(rows / cell_rows))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = found.where(F.size("dest") > 0).withColumn("group", F.pmod(F.xxhash64("key", F.lit(5)), F.lit(buckets)).cast("int"))
    lists = _grouped(found, buckets).applyInArrow(merged(k), columns)
    if others is None:
        return lists
    lists = stage(lists, "lists")
    whose = [ends.select("vec", F.col(c).alias("orig"), F.lit(w).alias("list")) for c, w in (("last", "nearest"), ("first", "farthest"))]
    theirs = lists.join(whose[0].unionByName(whose[1]), ["list", "orig"]).groupBy("list", "vec")
    theirs = theirs.agg(F.collect_list(F.struct("dest", "distance", "place")).alias("found"))
    copied = others.withColumnRenamed("key", "orig").join(theirs, "vec").select("list", "orig", F.inline("found"))
    return lists.unionByName(copied)


def _boxes(dealt: DataFrame, tree: Tree, width: int) -> Boxes:
    low, high = np.zeros((tree.cells, width)), np.zeros((tree.cells, width))
    rows, present = np.zeros(tree.cells, np.int64), np.zeros((tree.cells, width), bool)
    ends = [f(F.col("vec")[i]).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(width)]
    for r in dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), *ends).collect():
        rows[r.cell] = r.rows
        for out, name in ((low, "low"), (high, "high")):
            out[r.cell] = [np.nan if (x := r[f"{name}{i}"]) is None else x for i in range(width)]
        present[r.cell] = ~np.isnan(low[r.cell])
    # The pattern of a cell without rows does not matter, as nothing is sent there.
    return Boxes(np.nan_to_num(low, posinf=np.inf, neginf=-np.inf), np.nan_to_num(high, posinf=np.inf, neginf=-np.inf), present, rows)


def _few_of_each(edge: pa.Table, most: int) -> list[np.ndarray]:
    code = edge.column("code").to_numpy()
    return [matrix(edge.take(pa.array(np.flatnonzero(code == c)[:most]))) for c in np.unique(code)]


def _apart(edge: pa.Table, counts: dict[int, int], k: int, order: str) -> dict[int, pa.Array]:
    """For each pattern the first keys of those that share no coordinate with it, one more than k for the row itself."""
    code, keys, out = edge.column("code").to_numpy(), _one_chunk(edge.column("key")), {}
    place = pc.array_sort_indices(keys, order=order, null_placement="at_end").to_numpy()
    for own in counts:
        if len(some := place[code[place] & own == 0]):
            out[own] = keys.take(pa.array(some[: k + 1]))
    return out


def _nearest(dealt: DataFrame, boxes: Boxes, partner: dict[int, int], k: int, max_rows: int) -> list[DataFrame]:
    spark, kind, cells = dealt.sparkSession, dealt.schema["key"].dataType.simpleString(), len(boxes.rows)
    ends = f"bound double, dest array<{kind}>, distance array<double>"
    own = dealt.withColumn("group", F.col("cell"))
    own = stage(_grouped(own, cells).applyInArrow(own_lists(k), f"key {kind}, vec array<double>, cell int, {ends}"), "nearest")
    found, hosts = [own], dealt.withColumn("bound", F.lit(None).cast("double"))
    guests = own.select("key", "vec", "cell", "bound").withColumn("seen", F.lit(-1))
    rare = [i for i, code in enumerate(boxes.codes) if int(code) in partner and boxes.rows[i]]
    if rare:
        sites = F.broadcast(spark.createDataFrame([(i,) for i in rare], "cell int"))
        some = guests.join(sites, "cell", "left_semi")
        both, groups = _met(some, hosts, near_visits(boxes, partner, 1), cells, max_rows, False)
        if both is not None:
            met = stage(_grouped(both, groups).applyInArrow(guest_lists(k, False), f"key {kind}, met int, {ends}"), "nearest")
            found.append(met)
            same = some["key"].eqNullSafe(F.col("other"))
            better = some.drop("seen").join(met.select(F.col("key").alias("other"), F.col("bound").alias("better"), "met"), same, "left")
            seen = F.coalesce("met", F.lit(-1)).alias("seen")
            better = better.select("key", "vec", "cell", F.least("bound", "better").alias("bound"), seen)
            guests = stage(guests.join(sites, "cell", "left_anti").unionByName(better), "guests")
    both, groups = _met(guests, hosts, near_visits(boxes, partner, 2), cells, max_rows, False)
    if both is not None:
        found.append(_grouped(both, groups).applyInArrow(guest_lists(k, False), f"key {kind}, met int, {ends}"))
    return [x.select(F.lit(False).alias("far"), "key", "dest", "distance") for x in found]


def _farthest(
    dealt: DataFrame, boxes: Boxes, codes: Sequence[int], drawn: np.ndarray, witnesses: np.ndarray, k: int, max_rows: int
) -> list[DataFrame]:
    kind, cells, width = dealt.schema["key"].dataType.simpleString(), len(boxes.rows), boxes.low.shape[1]
    here = ~np.isnan(drawn)
    middle = np.where(here, drawn, 0.0).sum(axis=0) / np.maximum(here.sum(axis=0), 1)
    outer = np.zeros((0, width))
    if len(witnesses):
        outer = matrix(dealt.select("vec").mapInArrow(outer_rows(witnesses, middle, k), "vec array<double>").toArrow()).reshape(-1, width)
    if len(outer):
        outer = farthest_rows(outer, witnesses, middle, k)[0]
    outer = np.random.default_rng(0).permutation(outer)[:MAX_OUTER]
    limits = dealt.mapInArrow(far_limits(boxes, codes, outer, middle, k), "cell int, code int, bound double, need double")
    least, need = np.full(cells, np.inf), {code: np.full(cells, np.inf) for code in codes}
    for r in limits.groupBy("cell", "code").agg(F.min("bound").alias("bound"), F.min("need").alias("need")).collect():
        least[r.cell], need[r.code][r.cell] = r.bound, r.need
    visits = far_visits(boxes, least, need, middle)
    guests = dealt.mapInArrow(_with_bounds(outer, middle, k), f"key {kind}, vec array<double>, cell int, bound double")
    both, groups = _met(dealt, guests, visits, cells, max_rows, True)
    if both is None:
        return []
    found = _grouped(both, groups).applyInArrow(
        guest_lists(k, True), f"key {kind}, met int, bound double, dest array<{kind}>, distance array<double>"
    )
    return [found.select(F.lit(True).alias("far"), "key", "dest", "distance")]


def _with_bounds(outer: np.ndarray, middle: np.ndarray, k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(outer)):
            bound = pa.array(far_bounds(outer, middle, matrix(batch), k))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "vec", "cell")), bound], names=["key", "vec", "cell", "bound"])

    return run
