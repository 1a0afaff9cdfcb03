"""Nearest and farthest k without comparing all pairs: balls around pivots and the triangle inequality.

Rows are dealt to the nearest of some pivots; a pivot's rows, cut into parts of
bounded size, are balls with a centre and a radius.  For a row x and a ball
around c with radius r, every distance lies between |x - c| - r and |x - c| + r.
A row visits its most promising ball first, then a few more, then those of the
rest that can still improve on the k-th best found so far.  After each round the
lists are merged and the bound is the k-th of them; what is left out cannot be
in a list, ties by key included, so the lists are those of the full comparison.

Missing coordinates make distances no metric, so a ball has rows of one pattern
of presence.  Against it the bounds hold for every row x: over the coordinates S
that x shares with the pattern, and scaled by (all / |S|) as the distances are.
Each pattern that fills a ball has its own pivots, the ``MAX_PATTERNS`` most
common ones at most; rows of rarer patterns are in loose balls, which everybody
visits, and a row that shares no coordinate visits all balls.

Neighbouring balls form sets of bounded size.  A row goes once to each set with
a ball that it visits, with a bit for each ball, so rows that hardly any ball can
be ruled out for are copied as often as in the full comparison and not once a
ball.  In a set it is compared with the balls it visits, and only what reaches
its bound comes back.  Per round, the rows that go to one set are counted first.
A set with many is copied to several groups, so no task holds more than a bounded
number of rows.  Pivots, radii and counts, a row a ball, are all that reaches the
driver.
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

from peerlens.operators.blocks import MAX_BLOCK_BYTES, MAX_BLOCK_ROWS, MAX_TASKS, MIN_BLOCK_ROWS, Block, Products, best_of_tile, tiles
from peerlens.sources.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_PIVOTS = 2048
MAX_PATTERNS = 64
SET_BALLS = 256
CELLS = 1 << 19  # bounds of rows and balls held at once in a task, and found pairs before they are merged
BALL_ROWS = 2048  # rows a ball has on average, as long as there are pivots enough
ROUND_ENDS = (1, 5)  # a row visits its first ball, then the next four, then all others it must


@dataclass(frozen=True)
class Balls:
    """Centres and radii, loose balls last, with infinite radius.

    One pattern with its centres (over the pattern's coordinates), or several
    patterns, one a row, with a list of their centres; pivots are numbered through.
    """

    pattern: np.ndarray
    centres: np.ndarray | list[np.ndarray]
    pivot: np.ndarray  # of each ball; -1 for loose ones
    radius: np.ndarray
    rows: np.ndarray

    def __len__(self) -> int:
        return len(self.pivot)

    def by_pattern(self) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Each pattern, its centres and the number of its first pivot."""
        single, at = self.pattern.ndim == 1, 0
        for pattern, centres in [(self.pattern, self.centres)] if single else zip(self.pattern, self.centres):
            yield pattern, centres, at
            at += len(centres)


@dataclass(frozen=True)
class Sets:
    """Runs of neighbouring balls: the set of each ball and its place there."""

    of: np.ndarray
    place: np.ndarray
    size: int  # balls of the largest set

    def __len__(self) -> int:
        return int(self.of.max(initial=-1)) + 1


@dataclass
class Found:
    """The lists, and how many of all directed pairs were compared."""

    lists: DataFrame
    compared: int
    pairs: int


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that rows times ``width`` stay bounded."""
    step = max(1, CELLS // max(width, 1))
    for batch in batches:
        for low in range(0, batch.num_rows, step):
            yield batch.slice(low, step)


def _matrix(table: pa.RecordBatch) -> np.ndarray:
    vec = table.column("vec")
    flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(vec), -1)


def centre_distances(raw: np.ndarray, pattern: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows to pivots: distances over shared coordinates, how far off they may be, and each row's scale.

    The scale is that of all coordinates over the shared ones, infinite where
    there are none.
    """
    x = raw[:, pattern]
    here = ~np.isnan(x)
    shift = centres.mean(axis=0) if len(centres) else np.zeros(x.shape[1])
    x = np.where(here, x - shift, 0.0)
    c = centres - shift
    squares = (x * x).sum(axis=1)[:, None] - 2.0 * (x @ c.T) + here.astype(float) @ (c * c).T
    size = (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :]
    error = np.sqrt(8.0 * (2 * x.shape[1] + 8) * np.finfo(float).eps * size) + 1e-12
    used = here.sum(axis=1)
    with np.errstate(divide="ignore"):
        scale = np.where(used > 0, np.sqrt(raw.shape[1] / np.maximum(used, 1)), np.inf)
    return np.sqrt(np.maximum(squares, 0.0)), error, scale


def bounds(raw: np.ndarray, balls: Balls) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest distance a row can have to a ball's rows, on the safe side."""
    low, high = (np.full((len(raw), len(balls)), v) for v in (-np.inf, np.inf))
    for pattern, centres, at in balls.by_pattern():
        tight = np.flatnonzero((balls.pivot >= at) & (balls.pivot < at + len(centres)))
        if not len(tight):
            continue
        d, error, scale = centre_distances(raw, pattern, centres)
        d, error = d[:, balls.pivot[tight] - at], error[:, balls.pivot[tight] - at]
        some = np.isfinite(scale)
        s, r = scale[some, None], balls.radius[tight][None, :]
        # Ranks have nine decimals, hence the last term.
        slack = s * error[some] + 2e-9
        low[np.ix_(some, tight)] = s * (d[some] - r) - slack
        high[np.ix_(some, tight)] = s * (d[some] + r) + slack
    return low, high


def to_pivots(patterns: np.ndarray, centres: list[np.ndarray]) -> Callable:
    """Adds the nearest pivot of the row's pattern and the distance to it; -1 and null for rows of rare patterns."""
    width = max([1, *map(len, centres)])
    firsts = np.cumsum([0, *map(len, centres)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _slices(batches, width):
            raw = _matrix(table)
            here = ~np.isnan(raw)
            pivot, distance = np.full(len(raw), -1), np.full(len(raw), np.nan)
            for pattern, own_centres, first in zip(patterns, centres, firsts):
                own = (here == pattern).all(axis=1)
                if own.any() and len(own_centres):
                    d, error, _ = centre_distances(raw[own], pattern, own_centres)
                    best = d.argmin(axis=1)
                    at = np.arange(len(best)), best
                    pivot[own], distance[own] = first + best, d[at] + error[at]
            columns = [*table.columns, pa.array(pivot.astype(np.int32)), pa.array(distance, from_pandas=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*table.schema.names, "pivot", "off"])

    return run


def neighbouring(centres: np.ndarray) -> np.ndarray:
    """An order in which centres near each other mostly stand together: halves along the widest coordinate, and halves of these."""
    runs, order = [np.arange(len(centres))], []
    while runs:
        run = runs.pop()
        if len(run) <= 2 or not centres.shape[1]:
            order.append(run)
            continue
        spread = np.ptp(centres[run], axis=0)
        run = run[np.argsort(centres[run, spread.argmax()], kind="stable")]
        runs += [run[len(run) // 2 :], run[: len(run) // 2]]
    return np.concatenate(order) if order else np.arange(0)


def sets_of(balls: Balls, most_rows: int) -> Sets:
    """Balls in their order as sets of at most ``most_rows`` rows (or of one ball); loose ones apart."""
    of, place = np.zeros(len(balls), np.int64), np.zeros(len(balls), np.int64)
    number, rows, size = -1, 0, 0
    for i, n in enumerate(balls.rows):
        loose_from_here = i and balls.pivot[i] < 0 <= balls.pivot[i - 1]
        if number < 0 or rows + n > most_rows or size == SET_BALLS or loose_from_here:
            number, rows, size = number + 1, 0, 0
        of[i], place[i] = number, size
        rows, size = rows + int(n), size + 1
    return Sets(of, place, int(place.max(initial=0)) + 1)


def first_balls(balls: Balls, wanted: Sequence[str]) -> Callable:
    """Adds the balls that each row visits in the rounds before the last, the most promising first, loose ones apart."""
    tight = np.flatnonzero(balls.pivot >= 0)
    depth = min(ROUND_ENDS[-1], len(tight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _slices(batches, len(balls)):
            low, high = bounds(_matrix(table), balls)
            columns = []
            for which in wanted:
                score = -high[:, tight] if which == "farthest" else low[:, tight]
                best = np.argpartition(score, depth - 1, axis=1)[:, :depth] if depth else np.zeros((len(score), 0), int)
                order = np.take_along_axis(score, best, axis=1).argsort(axis=1, kind="stable")
                best = tight[np.take_along_axis(best, order, axis=1)].astype(np.int32)
                ends = pa.array(np.arange(0, best.size + 1, depth) if depth else np.zeros(len(score) + 1, int), pa.int32())
                columns.append(pa.ListArray.from_arrays(ends, pa.array(best.ravel())))
            yield pa.RecordBatch.from_arrays([*table.columns, *columns], names=[*table.schema.names, *wanted])

    return run


def visits(balls: Balls, sets: Sets, wanted: Sequence[str], number: int) -> Callable:
    """Rows ``(set, pairs, key, vec, ...)``: who goes where in round ``number``.

    For each list the bits of the set's balls that it asks for, and its limit.
    """
    loose = np.flatnonzero(balls.pivot < 0)
    no_limit = {"nearest": np.inf, "farthest": -np.inf}
    start = ROUND_ENDS[number - 1] if number else 0

    def planned(table: pa.RecordBatch, which: str) -> np.ndarray:
        out = np.zeros((table.num_rows, len(balls)), bool)
        first = table.column(which)
        depth = len(first.flatten()) // max(table.num_rows, 1)
        first = first.flatten().to_numpy().reshape(table.num_rows, depth)
        rows = np.arange(table.num_rows)[:, None]
        if number < len(ROUND_ENDS):
            out[rows, first[:, start : ROUND_ENDS[number]]] = True
        else:
            out[:] = True
            out[rows, first] = False
            out[:, loose] = False
        if number == 0:
            out[:, loose] = True
        return out

    def packed(go: np.ndarray, row: np.ndarray, at: np.ndarray) -> pa.Array:
        bits = np.zeros((len(go), len(sets), sets.size), bool)
        bits[:, sets.of, sets.place] = go
        data = np.packbits(bits, axis=2)[row, at]
        ends = np.arange(len(row) + 1, dtype=np.int32) * data.shape[1]
        return pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _slices(batches, len(sets) * sets.size):
            low, high = bounds(_matrix(table), balls)
            go, limits = {}, {}
            for which in wanted:
                go[which] = planned(table, which)
                limits[which] = np.full(table.num_rows, no_limit[which])
                if number:
                    limits[which] = table.column(f"{which}_limit").to_numpy(zero_copy_only=False)
                    limit = limits[which][:, None]
                    go[which] &= (high >= limit) if which == "farthest" else (low <= limit)
            any_list = np.logical_or.reduce([go[w] for w in wanted])
            pairs = np.zeros((table.num_rows, len(sets)), np.int64)
            np.add.at(pairs.T, sets.of, (any_list * balls.rows).T)
            row, at = np.nonzero(pairs)
            index = pa.array(row)
            columns = {"set": pa.array(at.astype(np.int32)), "pairs": pa.array(pairs[row, at])}
            columns |= {c: table.column(c).take(index) for c in ("key", "vec")}
            for which in wanted:
                columns |= {which: packed(go[which], row, at), f"{which}_limit": pa.array(limits[which][row])}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def lists_in_set(k: int, wanted: Sequence[str], schema: pa.Schema) -> Callable:
    """Group function: of the balls of a set that each row visits, the k best rows that reach its limit."""

    def merged(found: list, limit: np.ndarray, farthest: bool) -> tuple[list, np.ndarray]:
        """The k best of each row, and the limits that follow from them."""
        r, c, d, rank = (np.concatenate(x) for x in zip(*found))
        reach = np.where(np.isnan(rank), np.inf, rank)
        order = np.lexsort((-c, -reach, r) if farthest else (c, reach, r))
        r, reach = r[order], reach[order]
        place = np.arange(len(r)) - np.searchsorted(r, r, side="left")
        last, limit = place == k - 1, limit.copy()
        limit[r[last]] = (np.maximum if farthest else np.minimum)(limit[r[last]], reach[last])
        kept = order[(place < k) & ((reach >= limit[r]) if farthest else (reach <= limit[r]))]
        return [tuple(np.concatenate(x)[kept] for x in zip(*found))], limit

    def run(guests: pa.Table, hosts: pa.Table) -> pa.Table:
        parts = []
        if guests.num_rows and hosts.num_rows:
            a, b = paired(guests, hosts)
            place = b.table.column("place").to_numpy()
            at_home = pc.fill_null(pc.index_in(b.keys, a.keys), -1).to_numpy()
            members = {}
            for ball in np.unique(place):
                index = np.flatnonzero(place == ball)
                members[ball] = index[b.subset(index).rankable(k + 1)]
            for which in wanted:
                farthest = which == "farthest"
                data = np.frombuffer(b"".join(a.table.column(which).to_pylist()), np.uint8).reshape(len(a), -1)
                limit = a.table.column(f"{which}_limit").to_numpy()
                found, held = [], 0
                for ball, index in members.items():
                    rows = np.flatnonzero(data[:, ball >> 3] & (128 >> (ball & 7)))
                    if not len(rows):
                        continue
                    some, mine = a.subset(rows), b.subset(index)
                    among = np.full(len(a) + 1, -1)  # the last stands for those that are no guests
                    among[rows] = np.arange(len(rows))
                    own = among[at_home[index]]
                    products = Products(some, mine)
                    for tile in tiles(some, mine):
                        v = products.tile(tile)
                        r, c, d, rank = best_of_tile(v, products.error[tile], some, tile, mine, own, k, farthest, limit[rows[tile]])
                        found.append((rows[r], index[c], d, rank))
                        held += len(r)
                    if held > CELLS:
                        found, limit = merged(found, limit, farthest)
                        held = 0
                if found:
                    [(r, c, d, rank)], _ = merged(found, limit, farthest)
                    values = (pa.array(x, from_pandas=True) for x in (d, rank))
                    keys = a.keys.take(pa.array(r)), b.keys.take(pa.array(c))
                    parts.append(pa.Table.from_arrays([pa.array([which] * len(r), pa.string()), *keys, *values], schema=schema))
        return pa.concat_tables(parts) if parts else schema.empty_table()

    return run


def paired(guests: pa.Table, hosts: pa.Table) -> tuple[Block, Block]:
    """Both sides by key and with a common centre; keys are unique on either."""
    a, b = Block(guests), Block(hosts)
    for block in (a, b):
        if len(block) > 1 and pc.any(pc.equal(block.keys[1:], block.keys[:-1])).as_py():
            raise ValueError("organisation keys are not unique")
    counts = a.present.sum(axis=0) + b.present.sum(axis=0)
    shift = (np.nansum(a.raw, axis=0) + np.nansum(b.raw, axis=0)) / np.maximum(counts, 1)
    a.centre(shift)
    b.centre(shift)
    return a, b


def lists_in_ball(k: int, wanted: Sequence[str], schema: pa.Schema) -> Callable:
    """Group function: the k best of a ball's rows for each row that visits it."""

    def run(guests: pa.Table, hosts: pa.Table) -> pa.Table:
        parts = []
        if guests.num_rows and hosts.num_rows:
            a, b = paired(guests, hosts)
            b = b.subset(b.rankable(k + 1))
            for which in wanted:
                some = a.subset(np.flatnonzero(a.table.column(which).to_numpy()))
                if not len(some):
                    continue
                own = pc.fill_null(pc.index_in(b.keys, some.keys), -1).to_numpy()
                products = Products(some, b)
                for rows in tiles(some, b):
                    v = products.tile(rows)
                    r, c, d, rank = best_of_tile(v, products.error[rows], some, rows, b, own, k, which == "farthest")
                    orig, dest = some.keys.take(pa.array(r)), b.keys.take(pa.array(c))
                    values = (pa.array(x, from_pandas=True) for x in (d, rank))
                    parts.append(pa.Table.from_arrays([pa.array([which] * len(r), pa.string()), orig, dest, *values], schema=schema))
        return pa.concat_tables(parts) if parts else schema.empty_table()

    return run


def make_balls(vectors: DataFrame, rows: int, ball_rows: int, max_rows: int) -> tuple[DataFrame, Balls]:
    """The stored rows with their ball, and all balls."""
    spark = vectors.sparkSession
    here = F.transform("vec", lambda v: v.isNotNull() & ~F.isnan(v))
    common = vectors.groupBy(here.alias("pattern")).count().orderBy(F.desc("count"), F.col("pattern").cast("string")).limit(MAX_PATTERNS)
    known = [r for i, r in enumerate(common.collect()) if any(r.pattern or []) and (not i or r["count"] >= ball_rows)]
    patterns = np.array([r.pattern for r in known], bool).reshape(len(known), len(known[0].pattern) if known else 0)
    # A pattern gets pivots by its share of the rows.
    numbers = [max(1, min(MAX_PIVOTS * r["count"] // max(rows, 1), math.ceil(r["count"] / ball_rows))) for r in known]
    centres = [np.zeros((0, int(p.sum()))) for p in patterns]
    if known:
        of_pattern = spark.createDataFrame([(r.pattern, i) for i, r in enumerate(known)], "pattern array<boolean>, number int")
        place = F.row_number().over(Window.partitionBy("number").orderBy(F.xxhash64("key"), "key"))
        drawn = vectors.select("key", "vec", here.alias("pattern")).join(F.broadcast(of_pattern), "pattern").withColumn("place", place)
        drawn = drawn.where(F.col("place") <= max(numbers)).select("number", "place", "vec").collect()
        for i, pattern in enumerate(patterns):
            own = sorted((r for r in drawn if r.number == i and r.place <= numbers[i]), key=lambda r: r.place)
            some = np.array([r.vec for r in own], float).reshape(len(own), len(pattern))[:, pattern]
            centres[i] = some[neighbouring(some)]

    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
    dealt = stage(vectors.mapInArrow(to_pivots(patterns, centres), f"{columns}, pivot int, off double"), "pivots")
    counts = {r.pivot: r["count"] for r in dealt.groupBy("pivot").count().collect()}
    parts = {p: math.ceil(n / max_rows) for p, n in counts.items()}
    first, at = {}, 0
    for p in sorted(parts, key=lambda p: (p < 0, p)):
        first[p], at = at, at + parts[p]
    placing = spark.createDataFrame([(p, first[p], parts[p]) for p in parts], "pivot int, first int, parts int")
    part = F.pmod(F.xxhash64("key", F.lit(1)), F.col("parts")).cast("int")
    placed = dealt.join(F.broadcast(placing), "pivot").withColumn("ball", F.col("first") + part).drop("first", "parts")
    placed = stage(placed, "balls")
    pivot, radius, sizes = np.full(at, -1), np.full(at, np.inf), np.zeros(at, np.int64)
    for r in placed.groupBy("ball", "pivot").agg(F.max("off").alias("off"), F.count(F.lit(1)).alias("rows")).collect():
        pivot[r.ball], sizes[r.ball] = r.pivot, r.rows
        radius[r.ball] = np.inf if r.off is None else r.off
    return placed.select("key", "vec", "ball"), Balls(patterns, centres, pivot, radius, sizes)


def _limits(lists: DataFrame, k: int) -> DataFrame:
    """The k-th best distance of each row and list; what lets everything pass where there are fewer."""
    reach = F.coalesce(F.col("rank_distance"), F.lit(float("inf")))
    near, far = F.col("list") == "nearest", F.col("list") == "farthest"
    return lists.groupBy(F.col("orig").alias("key")).agg(
        F.when(F.count_if(near) >= k, F.max(F.when(near, reach))).otherwise(float("inf")).alias("nearest_limit"),
        F.when(F.count_if(far) >= k, F.min(F.when(far, reach))).otherwise(float("-inf")).alias("farthest_limit"),
    )


def best_k(lists: DataFrame, k: int) -> DataFrame:
    """The k first rows of each list, ties by key."""
    far, reach = F.col("list") == "farthest", F.coalesce(F.col("rank_distance"), F.lit(float("inf")))
    order = [
        F.when(far, -reach).otherwise(reach).asc(),
        F.when(~far, F.col("dest")).asc(),
        F.when(far, F.col("dest")).desc(),
    ]
    place = F.row_number().over(Window.partitionBy("list", "orig").orderBy(*order))
    return lists.withColumn("place", place).where(F.col("place") <= k).drop("place")


def ball_lists(
    vectors: DataFrame, k: int, wanted: Sequence[str], ball_rows: int = BALL_ROWS, max_rows: int = MAX_BLOCK_ROWS
) -> Found:
    """``(list, orig, dest, distance, rank_distance)`` of the stored ``vectors(key, vec)``: the k best of each row."""
    spark = vectors.sparkSession
    kind = vectors.schema["key"].dataType.simpleString()
    rows = vectors.count()
    hosts, balls = make_balls(vectors, rows, ball_rows, max_rows)
    order = ", ".join(f"{which} array<int>" for which in wanted)
    guests = hosts.mapInArrow(first_balls(balls, wanted), f"key {kind}, vec array<double>, ball int, {order}").drop("ball")
    guests = stage(guests, "guests")
    schema = f"list string, orig {kind}, dest {kind}, distance double, rank_distance double"
    as_arrow = spark.createDataFrame([], schema).toArrow().schema
    width = (vectors.select(F.size("vec")).first() or [1])[0]
    spread = math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism))
    most_rows = min(max_rows, max(1, MAX_BLOCK_BYTES // (8 * max(width, 1))), max(MIN_BLOCK_ROWS, math.ceil(rows / spread)))
    sets = sets_of(balls, most_rows)
    sites = spark.createDataFrame(list(zip(range(len(balls)), sets.of.tolist(), sets.place.tolist())), "ball int, set int, place int")
    hosts = hosts.join(F.broadcast(sites), "ball").drop("ball")
    asked = ", ".join(f"{which} binary, {which}_limit double" for which in wanted)
    lists, compared = spark.createDataFrame([], schema), 0
    for number in range(len(ROUND_ENDS) + 1):
        now = guests if not number else guests.join(_limits(lists, k), "key", "left").fillna(
            {"nearest_limit": float("inf"), "farthest_limit": float("-inf")}
        )
        sent = now.mapInArrow(visits(balls, sets, wanted, number), f"set int, pairs long, key {kind}, vec array<double>, {asked}")
        sent = stage(sent, "visits")
        counted = sent.groupBy("set").agg(F.count(F.lit(1)).alias("rows"), F.sum("pairs").alias("pairs")).collect()
        if not counted:
            continue
        compared += sum(r.pairs for r in counted)
        parts = {r.set: math.ceil(r.rows / most_rows) for r in counted}
        first, at = {}, 0
        for one, n in sorted(parts.items()):
            first[one], at = at, at + n
        groups = F.broadcast(spark.createDataFrame([(s, first[s], parts[s]) for s in parts], "set int, first int, parts int"))
        part = F.pmod(F.xxhash64("key", F.lit(2)), F.col("parts")).cast("int")
        coming = sent.drop("pairs").join(groups, "set").withColumn("group", F.col("first") + part).drop("set", "first", "parts")
        staying = hosts.join(groups, "set").withColumn(
            "group", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1))
        )
        staying = staying.select("key", "vec", "place", "group")
        # As many partitions as groups: a group is long work on few bytes, which must not be put together by bytes.
        left, right = (x.repartition(min(at, MAX_TASKS), "group").groupBy("group") for x in (coming, staying))
        found = left.cogroup(right).applyInArrow(lists_in_set(k, wanted, as_arrow), schema)
        lists = stage(best_k(lists.unionByName(found), k), "lists")
    return Found(lists, compared, rows * max(rows - 1, 0))
