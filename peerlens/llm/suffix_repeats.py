"""Passages that repeat across documents, by sparse suffix arrays over words.

A passage counts when ``length`` consecutive words (50) or more occur in another
row too.  Of all suffixes only those at minimisers are kept: of each run of
``length`` words, the one of its ``ANCHOR``-word sequences with the smallest hash
(the leftmost, if several).  What is kept depends on the run's own words alone,
so both places of a repeat keep the same suffix, about a tenth of all.

1. A kept suffix carries its first ``ANCHOR`` words' hash and, for each run that
   chose it, 32 bits of the run's hash: the suffix extended to the left by 0, 1,
   ... words and to the right by the rest.
2. Suffixes are dealt out by the hash of their first words and sorted by it.
   Neighbours that agree are extended: sorted again by the run's hash, and
   neighbours from different rows that agree are a match of ``length`` words.
   Both hashes together have 80 bits.
3. Matches return to their batch of documents, where overlapping ones join to
   spans; a repeat longer than ``length`` is the union of its runs.

Suffixes that a large share of all rows has would meet in one task.  They are
counted first, over all rows; batches leave out what is below half of the
share ``COMMON`` among their own rows, so whatever reaches ``COMMON`` overall is
counted with half of it at least.  At most 2 (suffixes a row) / ``COMMON`` can
be, so their list is bounded and goes to every task, and such a suffix is dealt
out by first words and run together.  Equal texts within a batch are matched
there and sent on once.

Words are lower-cased (A-Z).  Null, empty and shorter texts have no passages;
repeated rows repeat each other; a passage that repeats only within its own
row does not count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.llm.exchange import bucket_of, pack48, unpack48
from peerlens.llm.store import small_batches
from peerlens.llm.words import U64, Texts, lean, mix, powers, texts_of

ANCHOR = 32
BATCH_WORDS = 1 << 20
BATCH_DOCUMENTS = 60_000
BUCKET_WORDS = 1 << 19
COMMON = 0.002


def run_hash(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, texts not regarded."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    up, down = powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, U64)
    np.cumsum(words * up[: len(words)], dtype=U64, out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[:n] + U64(size))


def leftmost_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """Place of the smallest of each ``size`` neighbours, the leftmost of equal ones."""
    at, low, span = np.arange(len(values)), values, 1
    while span < size:
        step = min(span, size - span)
        less = low[step:] < low[:-step]
        at = np.where(less, at[step:], at[:-step])
        low = np.where(less, low[step:], low[:-step])
        span += step
    return at


def kept_suffixes(texts: Texts, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(first words' hash, text, first run's word, runs, the runs' hashes)`` of each kept suffix.

    Runs that chose a suffix follow one another.
    """
    words = texts.word_hash()
    if len(words) < length:
        return np.zeros(0, U64), *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, U64)
    anchors, runs = run_hash(words, ANCHOR), run_hash(words, length)
    chosen = leftmost_minimum(anchors, length - ANCHOR + 1)
    owner = texts.text_of_word()
    inside = np.flatnonzero(owner[: len(runs)] == owner[length - 1 :])
    chosen, runs = chosen[inside], runs[inside]
    fresh = np.ones(len(chosen), bool)
    fresh[1:] = (chosen[1:] != chosen[:-1]) | (np.diff(inside) != 1)
    heads = np.flatnonzero(fresh)
    text = owner[inside[heads]]
    return anchors[chosen[heads]], text, inside[heads] - texts.first[text], np.diff(np.r_[heads, len(chosen)]), runs


def common_suffixes(length: int):
    """Map function: ``(anchor, rows)`` of suffixes that many texts of a batch have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        documents = 0

        def flush() -> pa.RecordBatch:
            anchors, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts >= max(2, COMMON * documents / 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(anchors[many].view(np.int64)), pa.array(counts[many])], names=["anchor", "rows"]
            )

        for batch in batches:
            for texts in texts_of(batch.column("text")):
                anchors, text, *_ = kept_suffixes(texts, length)
                held.append(np.unique(np.stack([anchors, text.astype(U64)], axis=1), axis=0)[:, 0])
                documents += texts.rows
                if documents >= BATCH_DOCUMENTS:
                    yield flush()
                    held, documents = [], 0
        if held:
            yield flush()

    return run


FIELDS = ("tokens", "steps", "starts", "counts", "runs", "spans", "ids")
SCHEMA = "bucket int, batch long, " + ", ".join(f"{f} binary" for f in FIELDS)
ARROW = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), *((f, pa.binary()) for f in FIELDS)])


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, ARROW.types)], schema=ARROW)


def _ragged(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices ``first[i] .. first[i] + counts[i]`` of all i, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - counts), counts)


def deal_suffixes(length: int, buckets: int, common: np.ndarray):
    """Map function: the kept suffixes of each batch by first words, and the batch's own row."""

    def rows_of(number: int, parts: list[tuple], spans: list[np.ndarray], ids: list[pa.Array]) -> pa.RecordBatch:
        batch = (TaskContext.get().partitionId() << 32) + number
        anchors, places, starts, counts, runs = (np.concatenate([p[k] for p in parts]) for k in range(5))
        hot = np.isin(anchors, common)
        # A common suffix becomes one row a run, dealt by both.
        each = np.where(hot, counts, 1)
        source = np.repeat(np.arange(len(anchors)), each)
        first = (np.cumsum(counts) - counts)[source]
        offset = np.where(hot[source], _ragged(np.zeros(len(each), np.int64), each), 0)
        extension = np.zeros(len(source), U64)
        extension[hot[source]] = runs[(first + offset)[hot[source]]]
        # Minimisers are small hashes: scrambled again, they spread over all buckets.
        tokens = mix(anchors[source] ^ extension) >> U64(16)
        starts, places = starts[source] + offset, places[source]
        first, counts = first + offset, np.where(hot[source], 1, counts[source])
        to = bucket_of(tokens, 48, buckets)
        to = to.astype(np.uint16) if buckets <= 1 << 16 else to
        order = np.argsort(to, kind="stable")
        present, cuts = np.unique(to[order], return_index=True)
        short = (runs >> U64(32)).astype("<u4")
        out = []
        for b, x, y in zip(present.tolist(), cuts, [*cuts[1:], len(order)]):
            mine = order[x:y]
            out.append(
                (
                    b,
                    batch,
                    pack48(tokens[mine]),
                    np.diff(places[mine], prepend=0).astype("<u2").tobytes(),
                    starts[mine].astype("<u4").tobytes(),
                    counts[mine].astype(np.uint8).tobytes(),
                    short[_ragged(first[mine], counts[mine])].tobytes(),
                    b"",
                    b"",
                )
            )
        # The batch's own row has its ids (a null as the smallest number) and the spans it found itself.
        own = pa.concat_arrays(ids).fill_null(-(1 << 63)).to_numpy().astype("<i8").tobytes()
        local = np.concatenate(spans).astype("<i8").tobytes()
        out.append((int(batch % buckets), batch, b"", b"", b"", b"", b"", local, own))
        return _table(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, spans, ids, seen = 0, [], [], [], {}
        words = documents = 0
        for given in batches:
            for texts in texts_of(given.column("text")):
                if documents and (words + len(texts) > BATCH_WORDS or documents + texts.rows > BATCH_DOCUMENTS):
                    yield rows_of(number, parts, spans, ids)
                    number, parts, spans, ids, seen = number + 1, [], [], [], {}
                    words = documents = 0
                anchors, text, starts, counts, runs = kept_suffixes(texts, length)
                sizes = texts.counts()
                whole = whole_keys(texts)
                fresh, copies = np.ones(texts.rows, bool), []
                for row in np.flatnonzero(sizes >= length):
                    key = whole[row].tobytes()
                    if key in seen:
                        fresh[row] = False
                        copies += [(documents + row, 0, sizes[row]), (seen[key], 0, sizes[row])]
                    else:
                        seen[key] = documents + row
                keep = fresh[text]
                kept_runs = np.repeat(keep, counts)
                parts.append((anchors[keep], text[keep] + documents, starts[keep], counts[keep], runs[kept_runs]))
                spans.append(np.array(copies, np.int64).reshape(-1, 3))
                ids.append(given.column("doc_id").slice(texts.row, texts.rows))
                words, documents = words + len(texts), documents + texts.rows
        if documents:
            yield rows_of(number, parts, spans, ids)

    return run


def whole_keys(texts: Texts) -> np.ndarray:
    """128 bits of each text's word sequence."""
    words = texts.word_hash()
    up, _ = powers(len(words) + 1)
    place = np.arange(len(words)) - np.repeat(texts.first[:-1], texts.counts())
    out = np.empty((texts.rows, 2), U64)
    for k, salted in enumerate((words, mix(words))):
        sums = np.zeros(len(words) + 1, U64)
        np.cumsum(salted * up[place], dtype=U64, out=sums[1:])
        out[:, k] = mix(sums[texts.first[1:]] - sums[texts.first[:-1]])
    return out


def match_suffixes(length: int):
    """Group function: sorts the suffixes of a range of first words and extends neighbours that agree."""

    def run(table: pa.Table) -> pa.Table:
        own = pc.greater(pc.binary_length(table.column("ids")), 0)
        passed, table = table.filter(own), table.filter(pc.invert(own))
        read = {f: table.column(f).to_pylist() for f in ("tokens", "steps", "starts", "counts", "runs")}
        sizes = np.array([len(c) for c in read["counts"]], np.int64)
        tokens = unpack48(b"".join(read["tokens"]))
        places = np.cumsum(np.frombuffer(b"".join(read["steps"]), "<u2"), dtype=np.int64)
        before = np.concatenate([[0], places])[np.cumsum(sizes) - sizes]
        places -= np.repeat(before, sizes)
        batch = np.repeat(np.arange(len(sizes)), sizes)
        starts = np.frombuffer(b"".join(read["starts"]), "<u4").astype(np.int64)
        counts = np.frombuffer(b"".join(read["counts"]), np.uint8).astype(np.int64)
        runs = np.frombuffer(b"".join(read["runs"]), "<u4")

        order = np.argsort(tokens)
        ordered = tokens[order]
        like = np.zeros(len(order) + 1, bool)
        like[1:-1] = ordered[1:] == ordered[:-1]
        some = np.sort(order[like[1:] | like[:-1]])
        row = np.repeat(some, counts[some])
        entry = _ragged((np.cumsum(counts) - counts)[some], counts[some])
        start = starts[row] + _ragged(np.zeros(len(some), np.int64), counts[some])
        key = mix(tokens[row] ^ (runs[entry].astype(U64) << U64(32)) ^ mix(runs[entry].astype(U64)))
        order = np.argsort(key)
        ordered = key[order]
        heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)])
        text = (batch[row] << 32) + places[row]
        hits = np.zeros(len(order), bool)
        if len(heads):
            across = np.minimum.reduceat(text[order], heads) != np.maximum.reduceat(text[order], heads)
            hits[order] = np.repeat(across, np.diff(np.r_[heads, len(order)]))
        # Runs that follow one another in a text join at once.
        found = np.stack([text[hits], start[hits], start[hits] + length], axis=1)
        found = joined_spans(found)
        out = []
        cuts = np.flatnonzero(np.r_[True, (found[1:, 0] >> 32) != (found[:-1, 0] >> 32)][: len(found)])
        batches = table.column("batch").to_numpy()
        for x, y in zip(cuts, [*cuts[1:], len(found)]):
            mine = found[x:y].copy()
            number = int(batches[mine[0, 0] >> 32])
            mine[:, 0] &= (1 << 32) - 1
            out.append((0, number, b"", b"", b"", b"", b"", mine.astype("<i8").tobytes(), b""))
        return pa.concat_tables([passed, pa.Table.from_batches([_table(out)])])

    return run


def joined_spans(spans: np.ndarray) -> np.ndarray:
    """Rows ``(text, from, to)`` in order, those that overlap or touch joined."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    # A running maximum of the ends that starts anew at each text.
    number = np.cumsum(np.r_[True, spans[1:, 0] != spans[:-1, 0]])
    width = int(spans[:, 2].max()) + 1
    reach = np.maximum.accumulate(number * width + spans[:, 2]) - number * width
    fresh = np.r_[True, (spans[1:, 0] != spans[:-1, 0]) | (spans[1:, 1] > reach[:-1])]
    heads = np.flatnonzero(fresh)
    lasts = np.r_[heads[1:], len(spans)] - 1
    return np.stack([spans[heads, 0], spans[heads, 1], reach[lasts]], axis=1)


def spans_of_batch(table: pa.Table) -> pa.Table:
    """Group function: ``(doc_id, start_word, end_word)`` of one batch's documents."""
    ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), "<i8")
    spans = np.frombuffer(b"".join(table.column("spans").to_pylist()), "<i8").reshape(-1, 3)
    spans = joined_spans(spans.astype(np.int64))
    found = ids[spans[:, 0]]
    return pa.table(
        {
            "doc_id": pa.array(found, mask=found == -(1 << 63)),
            "start_word": spans[:, 1].copy(),
            "end_word": spans[:, 2].copy(),
        }
    )


def repeated_passages(docs: DataFrame, length: int = 50) -> DataFrame:
    """``(doc_id, start_word, end_word)``: the longest spans of ``docs(doc_id, text)`` made of repeated passages.

    Words count from 0, ``end_word`` is the first one after the span.  Each row
    is looked at by itself, also if it shares its id.
    """
    if length <= ANCHOR or length - ANCHOR > 254:  # a suffix's runs are counted in a byte
        raise ValueError(f"passages are longer than {ANCHOR} words, by 254 at most")
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = max(1, math.ceil(size[1] / 6 / BUCKET_WORDS))
    counted = rows.select("text").mapInArrow(common_suffixes(length), "anchor long, rows long")
    common = counted.groupBy("anchor").agg(F.sum("rows").alias("rows")).where(
        F.col("rows") >= max(1000, COMMON * size[0] / 2)
    )
    anchors = np.sort(np.array([r.anchor for r in common.select("anchor").collect()], np.int64).view(U64))
    dealt = rows.mapInArrow(deal_suffixes(length, buckets, anchors), SCHEMA)
    matched = dealt.groupBy("bucket").applyInArrow(lean(match_suffixes(length)), SCHEMA)
    return matched.groupBy("batch").applyInArrow(lean(spans_of_batch), "doc_id long, start_word long, end_word long")
