"""Documents drawn by how much their hashed features look like a target's.

Features are runs of one to ``LENGTH`` words, hashed by CRC-32 into buckets.
Bucket totals of the corpus and of the target are exact sums over all texts;
a document's weight is its features' mean gain, and the draw takes the highest
Gumbel-perturbed weights.

The vocabulary has a head and a tail.  Every batch names the words and pairs
that hold at least one in ``HEAD_WORDS`` (``HEAD_PAIRS``) of its own features,
so none that holds this share of the whole corpus is missed; the most frequent
of them are the head, its size bounded by these counts and by ``HEAD_BYTES`` a
word.  Tasks get the head's words with their CRC states and its pairs with
their buckets; a feature outside the head takes its CRC directly, a pair from
its first word's state on.  Which features are in the head changes no result.

A null or empty text has no features (weight 0).  A document with fewer words
than ``least_words`` is never drawn.  Repeated rows count and are drawn each on
their own; among equal scores and ids the order is open, the ranks are not.  A
null id hashes as an empty one and comes last among equal scores.  An empty
target or corpus has totals of 0.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peerlens.llm.store import small_batches, stored
from peerlens.llm.words import release

BUCKETS = 10_000
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 1 << 14, 1 << 16, 64
BLOCK_BYTES = 1 << 20

# What each byte becomes: A-Z their small letters, digits, a-z and all of UTF-8 beyond ASCII themselves, the rest a gap.
KEPT = np.zeros(256, np.uint8)
KEPT[128:] = np.arange(128, 256)
for first, last, shift in ((48, 57, 0), (97, 122, 0), (65, 90, 32)):
    KEPT[first : last + 1] = np.arange(first, last + 1) + shift

COUNTS = "feature binary, pair boolean, n long"
TOTALS = "bucket int, n long"
SCORES = "doc_id long, n_words long, n_features long, weight long, score long"


class Block:
    """Consecutive pieces of texts: their words by number and the distinct words.

    ``text`` is the text of each word; ``joined`` are the places of words that
    the next word of the same text follows.
    """

    def __init__(self, words: pa.Array, text: np.ndarray):
        coded = words.dictionary_encode()
        self.distinct: list[bytes] = coded.dictionary.to_pylist()
        self.word = coded.indices.to_numpy().astype(np.int64)
        self.text = text
        self.joined = np.flatnonzero(text[1:] == text[:-1])
        code = self.word[:-1][self.joined] * max(len(self.distinct), 1) + self.word[1:][self.joined]
        code, self.pair, self.pair_count = np.unique(code, return_inverse=True, return_counts=True)
        self.first, self.second = np.divmod(code, max(len(self.distinct), 1))

    def word_count(self) -> np.ndarray:
        return np.bincount(self.word, minlength=len(self.distinct))


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts that lie between ``bounds`` of ``data``, and the text of each."""
    kept = KEPT[data]
    inside = kept != 0
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    filled = np.diff(bounds) > 0
    opens[bounds[:-1][filled]] = inside[bounds[:-1][filled]]
    closes[bounds[1:][filled] - 1] = inside[bounds[1:][filled] - 1]
    starts, sizes = np.flatnonzero(opens), np.flatnonzero(closes) + 1 - np.flatnonzero(opens)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(kept[inside])]
    text = np.searchsorted(bounds, starts, side="right") - 1
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), text


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[Block, int]]:
    """All texts of a column, a block at a time; a longer text is cut in gaps between words.

    The last word before a cut is repeated at the start of the next block, so
    that no pair is lost; the second value is the number of words to pass over.
    """
    column = column.cast(pa.large_string()).fill_null("")
    rows = len(column)
    if not rows:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + rows + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    low = 0
    while low < rows:
        high = max(int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1, low + 1)
        if offsets[high] - offsets[low] <= limit:
            words, text = words_of(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            yield Block(words, text + low), 0
        else:
            yield from cut(data[offsets[low] : offsets[high]], low, limit)
        low = high


def cut(data: np.ndarray, text: int, limit: int) -> Iterator[tuple[Block, int]]:
    low, last = 0, None
    while low < len(data):
        high = min(low + limit, len(data))
        while high < len(data):  # on to the next gap
            gaps = np.flatnonzero(KEPT[data[high : high + limit]] == 0)
            if len(gaps):
                high += int(gaps[0])
                break
            high = min(high + limit, len(data))
        words, _ = words_of(data[low:high], np.array([0, high - low]))
        if len(words):
            if last is not None:
                words = pa.concat_arrays([last, words])
            yield Block(words, np.full(len(words), text)), int(last is not None)
            last = words.slice(len(words) - 1)
        low = high


def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and pairs with their share of a block's features or more, and how often it has them."""
    kinds = pa.schema([("feature", pa.binary()), ("pair", pa.bool_()), ("n", pa.int64())])
    for table in batches:
        for block, _ in blocks(table.column("text")):
            count, names = block.word_count(), block.distinct
            short = np.array([len(w) <= HEAD_BYTES for w in names], bool)
            words = np.flatnonzero((count * HEAD_WORDS >= len(block.word)) & short)
            pairs = block.pair_count * HEAD_PAIRS >= len(block.joined)
            pairs = np.flatnonzero(pairs & short[block.first] & short[block.second]) if len(names) else words
            features = [names[i] for i in words]
            features += [names[i] + b" " + names[j] for i, j in zip(block.first[pairs], block.second[pairs])]
            n = np.concatenate([count[words], block.pair_count[pairs]])
            is_pair = np.arange(len(features)) >= len(words)
            yield pa.RecordBatch.from_arrays([pa.array(features, pa.binary()), pa.array(is_pair), pa.array(n)], schema=kinds)
        release()


class Head:
    """The most frequent words with their CRC states, and pairs of them with their buckets.

    A word's state is the CRC of the word and a space, from which the CRC of a
    pair goes on.  ``codes`` are the pairs, by the numbers of their words, in
    order.
    """

    def __init__(self, words: list[bytes], pairs: list[bytes], buckets: int):
        parts = [tuple(p.split(b" ")) for p in pairs]
        words = list(dict.fromkeys([*words, *(w for p in parts for w in p)]))
        self.number = {w: i for i, w in enumerate(words)}
        self.buckets = buckets
        self.bucket = np.array([crc32(w) % buckets for w in words], np.int64)
        self.state = np.array([crc32(w + b" ") for w in words], np.int64)
        code = np.array([(self.number[a] << 32) | self.number[b] for a, b in parts], np.int64)
        order = np.argsort(code)
        self.codes = code[order]
        self.pair_bucket = np.array([crc32(p) % buckets for p in pairs], np.int64)[order]

    def hashed(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of a block's distinct words and of its distinct pairs."""
        number = np.fromiter(map(self.number.get, block.distinct, iter(lambda: -1, 0)), np.int64, len(block.distinct))
        known = number >= 0
        bucket, state = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        bucket[known], state[known] = self.bucket[number[known]], self.state[number[known]]
        for i in np.flatnonzero(~known).tolist():
            crc = crc32(block.distinct[i])
            bucket[i], state[i] = crc % self.buckets, crc32(b" ", crc)

        first, second = block.first, block.second
        code = (number[first] << 32) | number[second]
        place = np.minimum(np.searchsorted(self.codes, code), max(len(self.codes) - 1, 0))
        hit = known[first] & known[second] & (self.codes[place] == code if len(self.codes) else False)
        pair_bucket = np.zeros(len(first), np.int64)
        pair_bucket[hit] = self.pair_bucket[place[hit]]
        rest = np.flatnonzero(~hit)
        seconds = map(block.distinct.__getitem__, second[rest].tolist())
        direct = np.fromiter(map(crc32, seconds, state[first[rest]].tolist()), np.int64, len(rest))
        pair_bucket[rest] = direct % self.buckets
        return bucket, pair_bucket


def bucket_counts(head: Head):
    """A function that adds up a task's features by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(head.buckets, np.int64)
        for table in batches:
            for block, again in blocks(table.column("text")):
                bucket, pair_bucket = head.hashed(block)
                totals += np.bincount(bucket[block.word[again:]], minlength=head.buckets)
                np.add.at(totals, pair_bucket, block.pair_count)
            release()
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "n": totals[some]})

    return run


def gumbel(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scorer(head: Head, gains: np.ndarray, seed: int):
    """A function from documents to their numbers of words and features, weights and scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches:
            n_words, n_pairs, gain = (np.zeros(table.num_rows, np.int64) for _ in range(3))
            for block, again in blocks(table.column("text")):
                bucket, pair_bucket = head.hashed(block)
                of_word, of_pair = block.text[again:], block.text[block.joined]
                n_words += np.bincount(of_word, minlength=table.num_rows)
                n_pairs += np.bincount(of_pair, minlength=table.num_rows)
                np.add.at(gain, of_word, gains[bucket][block.word[again:]])
                np.add.at(gain, of_pair, gains[pair_bucket][block.pair])
            ids = table.column("doc_id").to_pylist()
            features = n_words + n_pairs
            weight = np.where(features > 0, gain // np.maximum(features, 1), 0)
            score = weight + np.array([gumbel(i, seed) for i in ids], np.int64)
            columns = [table.column("doc_id"), *map(pa.array, (n_words, features, weight, score))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight", "score"])
            release()

    return run


def find_head(texts: DataFrame, buckets: int) -> Head:
    counts = texts.mapInArrow(frequent, COUNTS).groupBy("feature", "pair").agg(F.sum("n").alias("n"))
    counts = stored(counts, "frequent")
    most = lambda pair, n: [
        bytes(r.feature) for r in counts.where(F.col("pair") == pair).orderBy(F.desc("n"), "feature").limit(n).collect()
    ]
    return Head(most(False, HEAD_WORDS), most(True, HEAD_PAIRS), buckets)


def bucket_totals(texts: DataFrame, head: Head) -> np.ndarray:
    """Exact number of features in each bucket; one row a bucket reaches the driver."""
    sums = texts.mapInArrow(bucket_counts(head), TOTALS).groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(head.buckets, np.int64)
    for bucket, n in sums.collect():
        out[bucket] = n
    return out


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log of the bucket's smoothed share of the target over that of the corpus)."""
    n, all_s, all_t = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (all_s + n) / ((s + 1.0) * (all_t + n))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's partition, and its place there from 1."""
    from pyspark import TaskContext

    part, seen = TaskContext.get().partitionId(), 0
    for table in batches:
        place = np.arange(seen + 1, seen + 1 + table.num_rows)
        seen += table.num_rows
        columns = [*table.columns, pa.array(np.full(table.num_rows, part, np.int64)), pa.array(place)]
        yield pa.RecordBatch.from_arrays(columns, names=[*table.schema.names, "part", "place"])


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scored`` (a stored table) with the rank of the drawn rows, null for the others.

    Rows that may be drawn are sorted by ranges; a row's rank is its place
    within its range and the rows of the ranges before.
    """
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    # The last key deals out rows that are equal in all others.
    keys = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc(F.monotonically_increasing_id())]
    kinds = able.schema.simpleString()[len("struct<") : -1].replace(":", " ").replace(",", ", ")
    sorted_rows = able.repartitionByRange(*keys).sortWithinPartitions(F.desc("score"), F.asc_nulls_last("doc_id"))
    placed = stored(sorted_rows.mapInArrow(numbered, f"{kinds}, part long, place long"), "ranges")
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    parts = parts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("place")
    taken = placed.join(parts, "part").withColumn("rank", F.when(rank <= drawn, rank)).select(*scored.columns, "rank")
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return taken.unionByName(rest)


def importance_sample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank, n_words)`` of each row of ``docs(doc_id, text)``.

    ``target(text)`` are the texts to resemble.
    """
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    only = texts.select("text")
    head = find_head(only, buckets)
    corpus = bucket_totals(only, head)
    wanted = bucket_totals(target.select(F.col("text").cast("string").alias("text")), head)
    scored = stored(texts.mapInArrow(scorer(head, gains_of(corpus, wanted), seed), SCORES), "scored")
    out = ranked(scored, percent, least_words)
    return out.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
