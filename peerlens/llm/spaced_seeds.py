"""Benchmark decontamination by spaced seeds.

A seed is a window of words of which a fixed mask reads some and ignores the
others, so a substituted word under an ignored position does not break it.
The seeds of all benchmark texts and of all documents are hashed under the
same masks; equal hashes mark the diagonals on which a document may hold part of
a text.  Along each such diagonal the two word sequences are compared position
by position; the overlap is the stretch with the most agreeing words of those
in which at most a share ``tolerance`` of the words differ.

An overlap is a leak when its agreeing words reach ``min_words`` or, for a
text with fewer words, ``share`` of all its words.  Words are lower-cased (A-Z)
and stripped of ASCII punctuation, so that layout does not hide a leak.  At the
default settings no leak on a diagonal is without a hit: texts of ten words up
have the masks below, texts of five to nine words one mask for each word that
may differ, and of shorter ones all words have to agree.  Looser settings may
name leaks that no mask hits.

The seed table goes to every task only after its size is known to be below
``part_words``; a larger benchmark is split by item into parts of that size,
each a pass over the documents, and the passes are combined.  Documents are
never shuffled.  Null and empty texts have no words and no leaks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerlens.llm.store import small_batches, stored
from peerlens.llm.words import LOWER, U64, Texts, mix, texts_of

# Masks: 1 reads the word, 0 ignores it.  Every arrangement of agreeing and differing words that is a leak of a text of
# MASKED words or more at the default settings holds one of them (found by search, proved over all arrangements).
MASKS = ("1111011", "110010111", "1110100011", "1011111", "1110111", "111100101")
MASKED = 10
FILTER_BITS = 22
PIECE = 1 << 20  # hits, and words compared, at a time

_bytes = np.arange(256)
_word = (_bytes >= 128) | ((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 65) & (_bytes <= 90))
_word |= (_bytes >= 97) & (_bytes <= 122)
PLAIN = np.where(_word | (_bytes == 39), LOWER, 32).astype(np.uint8)
FACTORS = mix(np.arange(1, 65, dtype=U64)) | U64(1)


def plain_words(texts: Texts) -> Texts:
    return Texts(PLAIN[texts.raw], texts.bounds, texts.row)


def seeds(words: np.ndarray, first: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the masked windows inside one text, and where they start."""
    read = [j for j, bit in enumerate(mask) if bit == "1"]
    size = len(mask)
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    summed = np.full(n, sum((int(b) << i) for i, b in enumerate(mask)), U64)
    for j in read:
        summed += words[j : j + n] * FACTORS[j]
    last = np.repeat(first[1:], np.diff(first))[:n]
    at = np.flatnonzero(np.arange(n) + size <= last)
    return mix(summed[at]), at


def masks_of(length: int) -> Sequence[str]:
    """The masks for a text of ``length`` words."""
    if length >= MASKED:
        return MASKS
    if length < 5:
        return ["1" * length]
    return sorted({("1" * i + "0" + "1" * (length - 1 - i)).strip("0") for i in range(length)})


@dataclass
class SeedTable:
    """Benchmark words and seeds, the seeds sorted by hash."""

    items: np.ndarray
    words: np.ndarray
    first: np.ndarray
    masks: list[str]
    hashes: np.ndarray
    at: np.ndarray
    item: np.ndarray

    @classmethod
    def of(cls, items: Sequence[int], texts: Sequence[str | None]) -> SeedTable:
        parts, counts = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        for block in texts_of(pa.array(list(texts), pa.large_string())):
            cut = plain_words(block)
            parts.append(cut.word_hash())
            counts.append(cut.counts())
        words, counts = np.concatenate(parts), np.concatenate(counts)
        first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        kind = np.minimum(counts, MASKED)
        kinds: dict[str, list[int]] = {}
        for n in np.unique(kind[kind > 0]):
            for m in masks_of(int(n)):
                kinds.setdefault(m, []).append(int(n))
        masks = list(kinds)
        item_of = np.repeat(np.arange(len(counts)), counts)
        found = [(np.zeros(0, U64), np.zeros(0, np.int64))]
        for m in masks:
            h, at = seeds(words, first, m)
            own = np.isin(kind[item_of[at]], kinds[m])
            found.append((h[own], at[own]))
        hashes, at = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        order = np.argsort(hashes, kind="stable")
        return cls(np.asarray(items, np.int64), words, first, masks, hashes[order], at[order], item_of[at[order]])

    def filter(self) -> np.ndarray:
        bits = np.zeros(1 << FILTER_BITS, bool)
        bits[(self.hashes >> U64(64 - FILTER_BITS)).astype(np.int64)] = True
        return bits


def overlap(same: np.ndarray, tolerance: float) -> tuple[int, int, int]:
    """``(start, end, agreeing)`` of the stretch with most agreeing words among those with a share ``tolerance`` of others at most."""
    score = np.round(np.concatenate([[0], np.cumsum(np.where(same, tolerance, tolerance - 1))]), 9)
    agree = np.concatenate([[0], np.cumsum(same)])
    starts = np.searchsorted(-np.minimum.accumulate(score), -score)  # the first place with no higher score
    end = int(np.argmax(agree - agree[starts]))
    start = int(starts[end])
    start += int(np.argmax(same[start:end])) if end > start else 0
    return start, end, int(agree[end] - agree[start])


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each of ``counts`` in a row, and its number among those of one place."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def pieces(counts: np.ndarray) -> Iterator[slice]:
    """Slices whose counts sum to ``PIECE`` at most, or of one entry."""
    ends = np.cumsum(counts)
    low = 0
    while low < len(counts):
        done = ends[low] - counts[low]
        high = max(low + 1, int(np.searchsorted(ends, done + PIECE, side="right")))
        yield slice(low, high)
        low = high


def distinct(rows: np.ndarray) -> np.ndarray:
    """The different columns of a table of numbers, in order of its rows."""
    rows = rows[:, np.lexsort(rows[::-1])]
    new = np.ones(rows.shape[1], bool)
    new[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
    return rows[:, new]


LEAKS = "item_id long, doc_word int, item_word int, n_words int, n_same int, item_words int"


def find(table: SeedTable, passed: list[str], min_words: int, share: float, tolerance: float):
    """Map function: the leaks of each document, one row for each item and diagonal."""
    wanted = np.minimum(min_words, np.ceil(np.round(share * np.diff(table.first), 9))).astype(np.int64)

    def diagonals(words: np.ndarray, first: np.ndarray, present: np.ndarray) -> np.ndarray:
        """Columns of text, item and how much later its words stand in the text, each once."""
        found = [np.zeros((3, 0), np.int64)]
        for m in table.masks:
            h, at = seeds(words, first, m)
            some = np.flatnonzero(present[(h >> U64(64 - FILTER_BITS)).astype(np.int64)])
            low = np.searchsorted(table.hashes, h[some])
            counts = np.searchsorted(table.hashes, h[some], side="right") - low
            some, low, counts = some[counts > 0], low[counts > 0], counts[counts > 0]
            text = np.searchsorted(first, at[some], side="right") - 1
            for part in pieces(counts):
                of, nth = spread(counts[part])
                s = low[part][of] + nth
                item = table.item[s]
                shift = (at[some][part] - first[text[part]])[of] - (table.at[s] - table.first[item])
                found.append(distinct(np.stack([text[part][of], item, shift])))
        return distinct(np.concatenate(found, axis=1))

    def leaks(words: np.ndarray, first: np.ndarray, present: np.ndarray) -> Iterator[tuple]:
        hits = diagonals(words, first, present)
        text, item, shift = hits
        start = np.maximum(0, -shift)
        size = np.minimum(np.diff(table.first)[item], np.diff(first)[text] - shift) - start
        for part in pieces(size):
            of, nth = spread(size[part])
            in_item = table.first[item[part]] + start[part]
            in_doc = first[text[part]] + shift[part] + start[part]
            same = words[in_doc[of] + nth] == table.words[in_item[of] + nth]
            ends = np.cumsum(size[part])
            many = np.bincount(of[same], minlength=len(ends)) >= wanted[item[part]]
            for k in np.flatnonzero(many):
                i = part.start + k
                low, high, agree = overlap(same[ends[k] - size[i] : ends[k]], tolerance)
                if agree >= wanted[item[i]]:
                    low, high = int(low + start[i]), int(high + start[i])
                    words_of = int(table.first[item[i] + 1] - table.first[item[i]])
                    yield int(text[i]), int(table.items[item[i]]), int(low + shift[i]), low, high - low, agree, words_of

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = table.filter()
        for batch in batches:
            rows: list[tuple] = []
            for texts in texts_of(batch.column("text")):
                cut = plain_words(texts)
                rows += [(texts.row + r[0], *r[1:]) for r in leaks(cut.word_hash(), cut.first, present)]
            take = pa.array([r[0] for r in rows], pa.int64())
            names = [f.split()[0] for f in LEAKS.split(", ")]
            types = [pa.int64()] + [pa.int32()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(take) for c in passed],
                    *[pa.array([r[k + 1] for r in rows], t) for k, t in enumerate(types)],
                ],
                names=[*passed, *names],
            )

    return run


def benchmark_parts(benchmark: DataFrame, part_words: int) -> Iterator[SeedTable]:
    """Seed tables of at most ``part_words`` words each (a longer text alone)."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    small = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    total = small.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    limit = 8 * part_words  # bytes
    if total <= limit:
        rows = sorted(tuple(r) for r in small.where("item_id IS NOT NULL").distinct().collect())
        if rows:
            yield SeedTable.of([r[0] for r in rows], [r[1] for r in rows])
        return
    parts = 2 * -(-total // limit)
    dealt = stored(small.where("item_id IS NOT NULL").distinct().withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))), "benchmark")
    for part in range(parts):
        rows = sorted(tuple(r) for r in dealt.where(F.col("part") == part).select("item_id", "text").collect())
        if rows:
            yield SeedTable.of([r[0] for r in rows], [r[1] for r in rows])


def benchmark_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    min_words: int = 13,
    share: float = 0.8,
    tolerance: float = 0.2,
    part_words: int = 2_000_000,
) -> DataFrame:
    """``(key, item_id, doc_word, item_word, n_words, n_same, item_words)`` for each leak found in ``docs(key, text)``.

    ``benchmark`` has ``item_id`` and ``text``; rows that lack either take no
    part.  Rows that repeat are reported as often.  Word places count from 0.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key), F.col("text").cast("string").alias("text"))
    kind = rows.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, {LEAKS}"
    found = None
    for part in benchmark_parts(benchmark, part_words):
        one = rows.mapInArrow(find(part, [key], min_words, share, tolerance), schema)
        found = one if found is None else found.unionByName(one)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def leaked_documents(leaks: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document and item: its leaks and the most words that agree in one."""
    return leaks.groupBy(key, "item_id").agg(
        F.count(F.lit(1)).alias("n_overlaps"), F.max("n_same").alias("n_same"), F.max("item_words").alias("item_words")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no leak; the columns stay and nothing is shuffled."""
    small_batches(docs.sparkSession)
    kind = docs.schema
    tables = list(benchmark_parts(benchmark, options.pop("part_words", 2_000_000)))
    settings = {"min_words": 13, "share": 0.8, "tolerance": 0.2} | options
    out = docs
    for part in tables:
        out = out.mapInArrow(clean_rows(part, **settings), kind)
    return out


def clean_rows(table: SeedTable, min_words: int, share: float, tolerance: float):
    """Map function: the rows without a leak, all columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = pa.array(np.arange(len(batch)))
            texts = batch.column(batch.schema.names.index("text")).cast(pa.string())
            asked = pa.RecordBatch.from_arrays([place, texts], names=["place", "text"])
            keep = np.ones(len(batch), bool)
            for leaks in find(table, ["place"], min_words, share, tolerance)(iter([asked])):
                keep[leaks.column("place").to_numpy()] = False
            yield batch.filter(pa.array(keep))

    return run
