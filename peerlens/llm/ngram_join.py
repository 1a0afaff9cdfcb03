"""Exact n-gram Jaccard self-join by a grouped prefix join.

1. Each text becomes its set of word n-grams (64-bit hashes, 48 bits kept as
   tokens).  Equal sets are one class, keyed by a 128-bit digest; within a batch
   of texts a class is sent on once.
2. Tokens are dealt out by token range.  There every token's frequency is
   counted exactly; only tokens of two documents or more go on, as no other
   can be in an intersection.
3. Back together by batch, tokens are ordered from rare to frequent.  Two sets
   that link share a token among the first ``n - ceil(t n) + 1`` of each.  A set
   whose own tokens fill its prefix links with nothing and ends here.  Sets of
   equal size and equal shared prefix form one group.
4. Groups that share a prefix token and lie in the same or the next size band
   are joined to their list's smallest group, in each batch first: a list is
   never expanded into pairs.  Components of these joins are candidates.
5. Each candidate component is expanded into its members and verified with
   products of 0/1 matrices; larger ones are cut into blocks by size, and only
   pairs of blocks whose sizes allow a link meet.  A task returns a row for
   each member (links, one forest edge), never the pairs.
6. Components of the forest edges are the classes asked for.

Nothing is capped or sampled.  Rows with a null id take no part (their
component is null).  Null and empty texts have an empty set and link with
nothing.  An id stands for one text; repeated rows are copies of each other.
Hashes make the join exact but for collisions: two given texts of a thousand
n-grams miscount one with a probability below 1e-8.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerlens.llm import exchange
from peerlens.llm.exchange import bucket_of, pack48, unpack48
from peerlens.llm.store import components, discard, small_batches, stored
from peerlens.llm.words import U64, distinct_windows, lean, mix, sums_by, texts_of

BATCH_TOKENS = 1 << 20
BATCH_DOCUMENTS = 60_000
BUCKET_TOKENS = 1 << 20
LIST_ROWS = 2000
BLOCK = 512
COLUMNS = 4096


def _keys(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """128-bit digests of the sets: order does not matter."""
    once = mix(h ^ U64(0x5851F42D4C957F2D))
    return np.stack([mix(sums_by(once, first)), mix(sums_by(mix(once), first))], axis=1)


def set_sizes(size: int):
    """Map function: ``(id, n_shingles, k1, k2)`` of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in texts_of(batch.column("text")):
                h, first = distinct_windows(texts, size)
                keys = _keys(h, first).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(texts.row, texts.rows),
                        pa.array(np.diff(first)),
                        pa.array(keys[:, 0].copy()),
                        pa.array(keys[:, 1].copy()),
                    ],
                    names=["doc_id", "n_shingles", "k1", "k2"],
                )

    return run


def deal_tokens(size: int, buckets: int):
    """Map function: the tokens of all texts by token range, a set that repeats within a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        number, seen, held, documents, count = 0, set(), [], [], 0

        def flush() -> pa.RecordBatch:
            batch = (task << 32) + number
            keys, sizes = (np.concatenate([d[k] for d in documents]) for k in (0, 1))
            places = np.repeat(np.arange(len(sizes)), sizes)
            rows = exchange.deal(batch, np.concatenate(held), places, buckets)
            own = (int(batch % buckets), batch, b"", b"", b"", keys.tobytes(), sizes.astype("<u4").tobytes())
            return exchange.table_of([*rows, own])

        for given in batches:
            for texts in texts_of(given.column("text")):
                h, first = distinct_windows(texts, size)
                keys, sizes = _keys(h, first), np.diff(first)
                fresh = sizes > 0
                for place in np.flatnonzero(fresh):
                    key = keys[place].tobytes()
                    fresh[place] = key not in seen
                    seen.add(key)
                if not fresh.any():
                    continue
                if count and (count + len(h) > BATCH_TOKENS or len(seen) > BATCH_DOCUMENTS):
                    yield flush()
                    number, seen, held, documents, count = number + 1, set(), [], [], 0
                    seen.update(k.tobytes() for k in keys[fresh])
                tokens = h[np.repeat(fresh, sizes)] >> U64(64 - exchange.TOKEN_BITS)
                held.append(tokens)
                documents.append((keys[fresh], sizes[fresh]))
                count += len(tokens)
        if documents:
            yield flush()

    return run


def count_tokens(table: pa.Table) -> pa.Table:
    """Group function: tokens of two documents or more, with their frequency's rank, by batch."""
    own = pc.greater(pc.binary_length(table.column("keys")), 0)
    passed = table.filter(own)
    got = exchange.unpack(table.filter(pc.invert(own)))
    order = np.argsort(got.tokens)
    ordered = got.tokens[order]
    heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)])
    lengths = np.diff(np.r_[heads, len(ordered)])
    frequency = np.empty(len(ordered), np.int64)
    frequency[order] = np.repeat(lengths, lengths)
    keep = np.flatnonzero(frequency > 1)
    ranks = np.minimum(255, 4 * np.log2(frequency[keep])).astype(np.uint8)
    row, tokens, places = got.row[keep], got.tokens[keep], got.places[keep]
    cuts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]][: len(row)])
    rows = [
        exchange.token_row(0, int(got.batches[row[x]]), tokens[x:y], places[x:y], ranks[x:y])
        for x, y in zip(cuts, [*cuts[1:], len(row)])
    ]
    return pa.concat_tables([passed, pa.Table.from_batches([exchange.table_of(rows)])])


SETS = "k1 long, k2 long, n long, prefix int, family long, tokens binary"


def find_prefixes(percent: int):
    """Group function: the documents of a batch whose prefix holds shared tokens, these from rare to frequent."""

    def run(table: pa.Table) -> pa.Table:
        got = exchange.unpack(table)
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), "<u8").reshape(-1, 2)
        sizes = np.frombuffer(b"".join(table.column("sizes").to_pylist()), "<u4").astype(np.int64)
        owner = got.places
        shared = np.bincount(owner, minlength=len(keys))
        prefix = sizes - -(-sizes * percent // 100) + 1 - (sizes - shared)
        keep = (prefix > 0)[owner]
        order = np.lexsort((got.tokens[keep], got.ranks[keep], owner[keep]))
        tokens, owner = got.tokens[keep][order], owner[keep][order]
        live = np.flatnonzero(prefix > 0)
        first = np.searchsorted(owner, np.r_[live, len(keys)])
        place = np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first))
        counted = np.where(place < np.repeat(prefix[live], np.diff(first)), mix(tokens), U64(0))
        family = mix(sums_by(counted, first) + mix(sizes[live].astype(U64)))
        signed = keys[live].view(np.int64)
        return pa.table(
            {
                "k1": signed[:, 0].copy(),
                "k2": signed[:, 1].copy(),
                "n": sizes[live],
                "prefix": prefix[live].astype(np.int32),
                "family": family.view(np.int64),
                "tokens": pa.array([pack48(tokens[a:b]) for a, b in zip(first[:-1], first[1:])], pa.binary()),
            }
        )

    return run


JOINS = "bucket int, entries binary, links binary"
JOIN_ARROW = pa.schema([("bucket", pa.int32()), ("entries", pa.binary()), ("links", pa.binary())])


def _to_smallest(lists: np.ndarray, families: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lists, their smallest family, and the distinct links ``(family, smallest)``."""
    order = np.lexsort((families, lists))
    lists, families = lists[order], families[order]
    fresh = np.r_[True, lists[1:] != lists[:-1]]
    least = families[fresh][np.cumsum(fresh) - 1]
    apart = families != least
    links = np.unique(np.stack([families[apart], least[apart]], axis=1), axis=0)
    return lists[fresh], families[fresh], links


def join_within_batch(buckets: int, percent: int):
    """Map function: prefix lists of each batch, one entry a list, and the links already made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(low, LIST_ROWS) for b in batches for low in range(0, len(b), LIST_ROWS)):
            prefix = batch.column("prefix").to_numpy().astype(np.int64)
            tokens = unpack48(b"".join(t[: 6 * p] for t, p in zip(batch.column("tokens").to_pylist(), prefix)))
            n = batch.column("n").to_numpy()
            band = np.floor(np.log(n) / math.log(max(100 / percent, 1.01)) + 1e-9).astype(np.int64)
            family = np.repeat(batch.column("family").to_numpy(), prefix)
            lists = np.concatenate(
                [mix(tokens + (np.repeat(band + k, prefix).astype(U64) << U64(48))) for k in (0, 1)]
            )
            lists, least, links = _to_smallest(lists, np.tile(family, 2))
            to = bucket_of(lists, 64, buckets)  # rises with the list
            present, cuts = np.unique(to, return_index=True)
            rows = [
                (b, np.stack([lists[x:y].view(np.int64), least[x:y]], axis=1).tobytes(), b"")
                for b, x, y in zip(present.tolist(), cuts, [*cuts[1:], len(to)])
            ]
            if rows:
                rows[0] = (*rows[0][:2], links.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), JOIN_ARROW.types)], schema=JOIN_ARROW
                )

    return run


def join_lists(table: pa.Table) -> pa.Table:
    """Group function: links ``(a, b)`` between families that share a list."""
    entries = np.frombuffer(b"".join(table.column("entries").to_pylist()), np.int64).reshape(-1, 2)
    made = np.frombuffer(b"".join(table.column("links").to_pylist()), np.int64).reshape(-1, 2)
    links = _to_smallest(entries[:, 0].view(U64), entries[:, 1])[2]
    both = np.unique(np.concatenate([links, made]), axis=0)
    return pa.table({"a": both[:, 0].copy(), "b": both[:, 1].copy()})


def _intersections(tokens: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices over bounded sets of columns."""
    m = len(tokens)
    flat = np.concatenate(tokens)
    owner = np.repeat(np.arange(m), [len(t) for t in tokens])
    _, column, copies = np.unique(flat, return_inverse=True, return_counts=True)
    keep = (copies > 1)[column]
    column = (np.cumsum(copies > 1) - 1)[column[keep]]
    owner = owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((m, m))
    last = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, last, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((m, min(COLUMNS, last - low)), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out


def _forest(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each row, the smallest id it is connected with."""
    root = ids.copy()
    todo = np.ones(len(ids), bool)
    for start in np.argsort(ids):
        if todo[start]:
            todo[start] = False
            stack = [start]
            while stack:
                near = np.flatnonzero(linked[stack.pop()] & todo)
                todo[near] = False
                root[near] = ids[start]
                stack.extend(near)
    return root


VERIFIED = "cid long, root long, links long"


def verify(percent: int):
    """Group function: links and a forest edge of each member of the blocks of candidates."""

    def run(table: pa.Table) -> pa.Table:
        cols = {name: table.column(name).to_numpy() for name in ("comp", "i", "j", "block", "cid", "copies", "n")}
        order = np.lexsort((cols["cid"], cols["j"], cols["i"], cols["comp"]))
        raw = table.column("tokens").to_pylist()
        cols = {name: c[order] for name, c in cols.items()}
        task = np.stack([cols["comp"], cols["i"], cols["j"]], axis=1)
        cuts = np.r_[np.flatnonzero(np.r_[True, (task[1:] != task[:-1]).any(axis=1)]), len(order)]
        out: list[np.ndarray] = []
        for low, high in zip(cuts[:-1], cuts[1:]):
            if high - low < 2:
                continue
            ids, n, copies = (cols[c][low:high] for c in ("cid", "n", "copies"))
            common = _intersections([unpack48(raw[x]) for x in order[low:high]])
            linked = 100 * common >= percent * (n[:, None] + n[None, :] - common)
            np.fill_diagonal(linked, False)
            if cols["i"][low] != cols["j"][low]:
                block = cols["block"][low:high]
                linked &= block[:, None] != block[None, :]
            links = linked @ copies
            some = links > 0
            if some.any():
                out.append(np.stack([ids[some], _forest(linked, ids)[some], links[some]], axis=1))
        rows = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
        return pa.table({name: rows[:, k].astype(np.int64) for k, name in enumerate(("cid", "root", "links"))})

    return run


def _blocks(members: DataFrame, percent: int) -> DataFrame:
    """Members with their block and the pairs of blocks they take part in."""
    sizes = members.groupBy("comp", "n").agg(F.count(F.lit(1)).alias("rows"))
    up = Window.partitionBy("comp").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("comp")
    ranges = (
        sizes.select("*", F.sum("rows").over(up).alias("to"), F.sum("rows").over(whole).alias("all"))
        .withColumn("width", F.when(F.col("all") <= 2 * BLOCK, F.lit(1 << 40)).otherwise(F.lit(BLOCK)))
        .selectExpr("comp", "n", "(to - rows) div width AS first", "(to - 1) div width AS last")
    )
    blocks = (
        ranges.select("comp", "n", F.explode(F.sequence("first", "last")).alias("block"))
        .groupBy("comp", "block")
        .agg(F.min("n").alias("low"), F.max("n").alias("high"))
    )
    left = blocks.select("comp", F.col("block").alias("i"), F.col("high").alias("i_high"))
    right = blocks.select("comp", F.col("block").alias("j"), F.col("low").alias("j_low"))
    pairs = left.join(right, "comp").where(f"j >= i AND 100 * i_high >= {percent} * j_low")
    takes = pairs.select("comp", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    placed = members.join(ranges, ["comp", "n"]).withColumn(
        "block", F.expr("first + pmod(xxhash64(cid), last - first + 1)")
    )
    return placed.drop("first", "last").join(takes, ["comp", "block"])


def ngram_groups(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_links)`` of each row of ``docs(doc_id, text)``.

    Other columns are ignored.  ``n_links`` counts the other rows that the row
    links with directly, copies included.
    """
    small_batches(docs.sparkSession)
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = whole.where("doc_id IS NOT NULL")
    sized = stored(
        whole.mapInArrow(set_sizes(words), "doc_id long, n_shingles long, k1 long, k2 long"), "set-sizes"
    )
    classes = (
        sized.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("k1", "k2")
        .agg(F.min("doc_id").alias("cid"), F.count(F.lit(1)).alias("copies"))
    )
    total = sized.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(total / BUCKET_TOKENS))

    dealt = known.select("text").mapInArrow(deal_tokens(words, buckets), exchange.SCHEMA)
    shared = dealt.groupBy("bucket").applyInArrow(lean(count_tokens), exchange.SCHEMA)
    sets = stored(shared.groupBy("batch").applyInArrow(lean(find_prefixes(percent)), SETS), "sets")

    lists = sets.select("n", "prefix", "family", "tokens").mapInArrow(join_within_batch(buckets, percent), JOINS)
    links = lists.groupBy("bucket").applyInArrow(lean(join_lists), "a long, b long")
    candidates = components(links).withColumnRenamed("node", "family").withColumnRenamed("component", "comp")
    # A class comes once from each batch that has a copy; all its rows are the same.
    copy = Window.partitionBy("k1", "k2").orderBy("n")
    members = (
        sets.select("k1", "k2", "n", "family", "tokens")
        .join(classes, ["k1", "k2"])
        .withColumn("copy", F.row_number().over(copy))
        .where("copy = 1")
        .join(candidates, "family", "left")
        .select(F.coalesce("comp", "family").alias("comp"), "cid", "copies", "n", "tokens")
    )
    members = stored(members, "members")
    tasks = _blocks(members, percent).withColumn("task", F.expr(f"pmod(xxhash64(comp, i, j), {4 * buckets})"))
    verified = stored(
        tasks.select("task", "comp", "i", "j", "block", "cid", "copies", "n", "tokens")
        .groupBy("task")
        .applyInArrow(lean(verify(percent)), VERIFIED),
        "verified",
    )
    discard(sets)
    discard(members)
    joined = components(verified.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links_of = verified.groupBy("cid").agg(F.sum("links").alias("links"))
    class_rows = (
        classes.join(links_of, "cid", "left")
        .join(joined.withColumnRenamed("node", "cid"), "cid", "left")
        .select(
            "k1",
            "k2",
            F.coalesce("component", "cid").alias("class_component"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("class_links"),
        )
    )
    linkable = F.expr("n_shingles > 0 AND doc_id IS NOT NULL")
    return (
        sized.withColumn("linkable", linkable)
        .join(class_rows.withColumn("linkable", F.lit(True)), ["k1", "k2", "linkable"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("class_component", "doc_id").alias("component_id"),
            F.coalesce("class_links", F.lit(0)).cast("long").alias("n_links"),
        )
    )


def one_of_each_group(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """One row of ``docs`` of each component, that with the smallest id; the columns stay.

    Rows without an id or without words are in no group and stay.  Rows that
    repeat an id are told apart: each goes or stays by its own text.
    """
    number = "__row_number"
    # Stored with their numbers, which stand for the ids from here on.
    rows = stored(docs.withColumn(number, F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())), "rows")
    numbered = rows.select(F.col(number).alias("doc_id"), "text")
    grouped = stored(ngram_groups(numbered, words, percent), "groups").where("n_shingles > 0 AND doc_id IS NOT NULL")
    ids = rows.select(F.col(number).alias("doc_id"), F.col("doc_id").cast("long").alias("id"))
    members = grouped.select("doc_id", "component_id").join(ids, "doc_id")
    stays = members.groupBy("component_id").agg(F.min(F.struct("id", "doc_id")).alias("first")).select("first.doc_id")
    # Stored, so that Spark knows its size and shuffles the texts only if it is large.
    gone = stored(members.select("doc_id").join(stays, "doc_id", "left_anti").select(F.col("doc_id").alias("gone")), "gone")
    return rows.join(gone, F.col(number) == F.col("gone"), "left_anti").drop(number)
