"""Tokens of two tokenizers aligned by the bytes they cover.

Every text is encoded once by a byte-level BPE (A, space and text) and once by
a byte-fallback sentence-piece BPE (B, which adds the space).  ``merge_asof``
keyed by document gives each token start the other side's covering token; the
union of both directions are the overlaps, and overlaps that end together are
the links and close the groups.

A batch of documents counts its linked id pairs before anything is shuffled.
Counts of all batches are added up by pair, joined back to the batches that
have the pair, and each batch meets its documents' links again by its number,
so a group holds one batch of bounded bytes (or one longer text).

Null and empty texts have no tokens, nor have texts whose token bytes do not
give back space and text (a literal U+2581, say): zeros and ``''``.  Texts that
are longer than ``SEGMENT`` characters are encoded in pieces cut where neither
tokenizer joins tokens, with the same result.  Repeated rows count each; a null
id stays null.  No documents: no rows.

Both tokenizers end a token where the segments are cut, and at every other
space of that sort.  So a task encodes the words between two such places once
each, as long as it remembers them, and puts the texts' tokens together.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain, compress, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerlens.llm.store import small_batches, stored
from peerlens.llm.words import release

SEGMENT = 1 << 16
BLOCK = 1 << 19
KNOWN_WORDS = 1 << 18
CUT = re.compile(r"(?<=\S) (?=\S)")
EMPTY = np.zeros(0, np.int64)

NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")
STORED = (
    "batch long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, "
    "groups_sha256 string, links binary, pairs binary, counts binary"
)
PAIRS = "batch long, a int, b int, n long"
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, n_overlaps long"
)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable characters of Latin-1 stand for themselves, the other bytes in
    order for the characters from U+0100.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def segments(text: str, limit: int = SEGMENT) -> list[str]:
    """Pieces of about ``limit`` characters; all but the first lack the space they are cut at.

    A cut replaces one space between two characters that are not white space:
    there the one tokenizer starts a new word and the other has no piece with
    a space after a letter.
    """
    out, low = [], 0
    while len(text) - low > limit and (cut := CUT.search(text, low + limit)):
        out.append(text[low : cut.start()])
        low = cut.end()
    return [*out, text[low:]]


class Tokenizers:
    """Both tokenizers and the bytes of each of their ids."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=piece_bpe)
        letters = byte_letters()
        by_id = {i: entry for entry, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [bytes(letters.get(c, 0) for c in by_id.get(i, "")) for i in range(max(by_id) + 1)]
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # Decimal ids with what may follow: a comma, or the end of a group's side.
        self.a_words = [f"{i}{after}" for after in ",|" for i in range(len(self.a_bytes))]
        self.b_words = [f"{i}{after}" for after in ",;" for i in range(len(self.b_bytes))]

    def encode(self, words: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of both sides of each word, and whether both give back space and word."""
        spaced = [" " + w for w in words]
        whole = [w.encode() for w in spaced]
        a_ids = [x.ids for x in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        b_ids = self.b.encode(words, num_threads=1)
        sound = given_back(a_ids, self.a_bytes, self.a_sizes, whole) & given_back(b_ids, self.b_bytes, self.b_sizes, whole)
        return a_ids, b_ids, sound


def given_back(ids: list[list[int]], table: list[bytes], sizes: np.ndarray, whole: list[bytes]) -> np.ndarray:
    """Of each word whether its tokens' bytes, put together, are the word's: first by length, then byte by byte for all at once."""
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int64, counts.sum())
    length = np.fromiter(map(len, whole), np.int64, len(whole))
    ends = np.cumsum(np.concatenate([[0], sizes[flat]]))[np.concatenate([[0], np.cumsum(counts)])]
    same = np.diff(ends) == length
    kept = flat if same.all() else flat[np.repeat(same, counts)]
    found = np.frombuffer(b"".join(map(table.__getitem__, kept.tolist())), np.uint8)
    wanted = np.frombuffer(b"".join(whole if same.all() else compress(whole, same)), np.uint8)
    other = np.flatnonzero(found != wanted)
    if len(other):
        place = np.flatnonzero(same)
        same[place[np.searchsorted(np.cumsum(length[place]), other, side="right")]] = False
    return same


class Side:
    """Ids of the words known so far, one after the other."""

    def __init__(self) -> None:
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def add(self, ids: list[list[int]]) -> None:
        ends = self.ends[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(ids), np.int32)])
        self.ends = np.concatenate([self.ends, ends])

    def keep(self, words: np.ndarray) -> None:
        """Only these words, numbered in this order from now on."""
        self.ids, sizes = self.of(words)
        self.ends = np.cumsum(np.concatenate([[0], sizes]))

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these words in order, and how many each has."""
        low, sizes = self.ends[words], self.ends[words + 1] - self.ends[words]
        before = np.cumsum(sizes) - sizes
        return self.ids[np.repeat(low - before, sizes) + np.arange(sizes.sum())], sizes


class Encoder:
    """Encodes each distinct word, that is what stands between two cuts, once.

    When there are many, those used least are forgotten, half of them at least.
    """

    def __init__(self, tools: Tokenizers):
        self.tools = tools
        self.place: dict[str, int] = {}
        self.a, self.b, self.sound, self.uses = Side(), Side(), np.zeros(0, bool), np.zeros(0, np.int64)

    def forget(self) -> None:
        """The words used most stay, of equally often used ones all or none."""
        least = np.partition(self.uses, len(self.uses) // 2)[len(self.uses) // 2]
        kept = self.uses > least
        words = np.flatnonzero(kept)
        self.place = {w: i for i, w in enumerate(compress(self.place, kept))}
        self.a.keep(words)
        self.b.keep(words)
        self.sound, self.uses = self.sound[words], self.uses[words] >> 1

    def tokens(self, pieces: list[str]) -> tuple[pd.DataFrame, pd.DataFrame, np.ndarray]:
        """Both sides' tokens of the sound pieces, and which these are."""
        if len(self.place) > KNOWN_WORDS:
            self.forget()
        cut = [CUT.split(p) for p in pieces]
        number, distinct = pd.factorize(np.array(list(chain.from_iterable(cut)), object))
        place, known = self.place, len(self.place)
        at = np.fromiter(map(place.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = list(compress(distinct, at < 0))
        if new:
            numbers = range(known, known + len(new))
            place.update(zip(new, numbers))
            at[at < 0] = numbers
            a_ids, b_ids, sound = self.tools.encode(new)
            self.a.add(a_ids)
            self.b.add(b_ids)
            self.sound = np.concatenate([self.sound, sound])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        words = at[number]
        self.uses += np.bincount(words, minlength=len(place))
        piece = np.repeat(np.arange(len(pieces)), [len(ws) for ws in cut])
        sound = np.bincount(piece[~self.sound[words]], minlength=len(pieces)) == 0
        # Where a side does not give back the bytes, the sides' offsets part ways: such pieces stay out.
        words, piece = words[sound[piece]], piece[sound[piece]]
        sides = (placed(*side.of(words), piece, sizes) for side, sizes in ((self.a, self.tools.a_sizes), (self.b, self.tools.b_sizes)))
        return *sides, sound


def placed(ids: np.ndarray, counts: np.ndarray, doc: np.ndarray, sizes: np.ndarray) -> pd.DataFrame:
    """Tokens of consecutive words with their pieces and byte ranges, counted on through all of them."""
    end = np.cumsum(sizes[ids])
    columns = {"at": end - sizes[ids], "doc": np.repeat(doc, counts), "id": ids, "end": end, "token": np.arange(len(ids))}
    return pd.DataFrame(columns)


def overlapping(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs of overlapping tokens: each start finds the token of the other side that covers it."""
    a, b = (side[["at", "doc", "token"]] for side in (a, b))
    over_a = pd.merge_asof(a, b, on="at", by="doc", suffixes=("_a", "_b"))
    over_b = pd.merge_asof(b, a.assign(start_a=a["at"]), on="at", by="doc", suffixes=("_b", "_a"))
    over_b = over_b[over_b["start_a"] != over_b["at"]]  # equal starts are in the first half
    columns = ["doc", "token_a", "token_b"]
    return pd.concat([over_a[columns], over_b[columns]], ignore_index=True)


def written(tools: Tokenizers, a: pd.DataFrame, b: pd.DataFrame, links: pd.DataFrame, pieces: int) -> list[bytes]:
    """Each piece's groups in their written form."""
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[links["token_a"]] = True
    last_b[links["token_b"]] = True
    group_a = np.cumsum(last_a) - last_a
    group_b = np.cumsum(last_b) - last_b
    # Group by group, first A's tokens, then B's.
    in_a, in_b = (np.bincount(group, minlength=len(links) + 1) for group in (group_a, group_b))
    place_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]
    place_b = np.arange(len(b)) + np.cumsum(in_a)[group_b]
    words = np.empty(len(a) + len(b), np.int64)
    words[place_a] = a["id"].to_numpy() + last_a * len(tools.a_bytes)
    words[place_b] = b["id"].to_numpy() + last_b * len(tools.b_bytes) + len(tools.a_words)
    table = tools.a_words + tools.b_words
    sizes = np.bincount(a["doc"], minlength=pieces) + np.bincount(b["doc"], minlength=pieces)
    ends = np.cumsum(sizes)
    return [
        "".join(map(table.__getitem__, words[low:high].tolist()))[:-1].encode()
        for low, high in zip((ends - sizes).tolist(), ends.tolist())
    ]


def align(encoder: Encoder, pieces: list[str]) -> tuple[np.ndarray, dict[str, np.ndarray], list[bytes], np.ndarray, np.ndarray]:
    """Of each piece whether it is sound, its numbers and its groups; the links' pieces and pair codes, in order."""
    a, b, sound = encoder.tokens(pieces)
    overlaps = overlapping(a, b)
    at_a, at_b = (overlaps[column].to_numpy() for column in ("token_a", "token_b"))
    end_a = a["end"].to_numpy()[at_a]
    links = overlaps.assign(end=end_a)[end_a == b["end"].to_numpy()[at_b]].sort_values("token_a", kind="stable")
    per_piece = lambda column: np.bincount(column, minlength=len(pieces))
    numbers = {
        "n_a": per_piece(a["doc"]),
        "n_b": per_piece(b["doc"]),
        # A group ends with each byte offset at which both sides have an end.
        "n_groups": per_piece(links["doc"][np.diff(links["end"], prepend=-1) > 0]),
        "n_links": per_piece(links["doc"]),
        "n_overlaps": per_piece(overlaps["doc"]),
    }
    id_a, id_b = (side["id"].to_numpy()[links[token]] for side, token in ((a, "token_a"), (b, "token_b")))
    code = id_a.astype(np.int64) * len(encoder.tools.b_bytes) + id_b
    return sound, numbers, written(encoder.tools, a, b, links, len(pieces)), links["doc"].to_numpy(), code


def blocks(texts: list[str], limit: int = BLOCK) -> Iterator[tuple[list[int], list[str]]]:
    """The texts' pieces, some at a time, with the number of the text that each is of."""
    owner, pieces, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in segments(text) if text else []:
            if pieces and size + len(piece) > limit:
                yield owner, pieces
                owner, pieces, size = [], [], 0
            owner.append(i)
            pieces.append(piece)
            size += len(piece)
    if pieces:
        yield owner, pieces


class Batch:
    """What is known of the texts of one batch.

    Both sides end a token where a text is cut, so its pieces are aligned on
    their own and no more than a block of them is held in full.
    """

    def __init__(self, rows: int):
        self.sound = np.ones(rows, bool)
        self.numbers = {name: np.zeros(rows, np.int64) for name in NUMBERS}
        self.groups: list = [None] * rows
        self.docs, self.codes = [EMPTY], [EMPTY]

    def add(self, owner: list[int], found: tuple) -> None:
        sound, numbers, groups, piece, code = found
        of = np.array(owner)
        self.sound[of[~sound]] = False
        for name, values in numbers.items():
            np.add.at(self.numbers[name], of, values)
        for i, text in zip(owner, groups):
            if self.groups[i] is None:
                self.groups[i] = hashlib.sha256(text)
            else:
                self.groups[i].update(b";" + text)
        self.docs.append(of[piece])
        self.codes.append(code)

    def rows(self, batch: int, ids: list) -> pa.RecordBatch:
        """One row a text, then the batch's own with its distinct pairs and their numbers."""
        doc, code = np.concatenate(self.docs), np.concatenate(self.codes)
        doc, code = doc[self.sound[doc]], code[self.sound[doc]]
        place, distinct = pd.factorize(code, sort=True)
        n = np.bincount(place, minlength=len(distinct))
        place, first = place.astype("<u4"), np.searchsorted(doc, np.arange(len(ids) + 1))
        some = self.sound & (self.numbers["n_a"] > 0)
        columns = {
            "batch": [batch] * (len(ids) + 1),
            "doc_id": [*ids, None],
            "groups_sha256": [h.hexdigest() if ok else "" for h, ok in zip(self.groups, some)] + [None],
            "links": [place[x:y].tobytes() for x, y in zip(first[:-1], first[1:])] + [None],
            "pairs": [None] * len(ids) + [distinct.astype("<i8").tobytes()],
            "counts": [None] * len(ids) + [n.astype("<i8").tobytes()],
        } | {name: (values * some).tolist() + [None] for name, values in self.numbers.items()}
        schema = arrow_schema(STORED)
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def aligner(byte_bpe: bytes, piece_bpe: bytes):
    """A function from batches of documents to what is stored of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = Encoder(Tokenizers(byte_bpe, piece_bpe))
        for number, table in enumerate(batches):
            batch = Batch(table.num_rows)
            for owner, pieces in blocks(table.column("text").to_pylist()):
                batch.add(owner, align(encoder, pieces))
            yield batch.rows((TaskContext.get().partitionId() << 32) + number, table.column("doc_id").to_pylist())
            release()

    return run


def pair_rows(sizes_b: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(PAIRS)
        for table in batches:
            for batch, pairs, counts in zip(*(table.column(c).to_pylist() for c in ("batch", "pairs", "counts"))):
                code, n = np.frombuffer(pairs, "<i8"), np.frombuffer(counts, "<i8")
                columns = [np.full(len(code), batch), (code // sizes_b).astype("i4"), (code % sizes_b).astype("i4"), n]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return run


def counted(sizes_b: int):
    """One batch's documents with the sums over their links."""

    def run(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        code = pairs.column("a").to_numpy().astype(np.int64) * sizes_b + pairs.column("b").to_numpy()
        order = np.argsort(code)  # the order in which the batch numbered its pairs
        count = pairs.column("count").to_numpy()[order]
        best = pairs.column("best").to_numpy(zero_copy_only=False).astype(np.int64)[order]
        sums: dict[str, list[int]] = {"n_best": [], "count_sum": []}
        for links in rows.column("links").to_pylist():
            place = np.frombuffer(links, "<u4")
            sums["n_best"].append(int(best[place].sum()))
            sums["count_sum"].append(int(count[place].sum()))
        schema = arrow_schema(RESULT)
        columns = [pa.array(sums[f.name], f.type) if f.name in sums else rows.column(f.name) for f in schema]
        out = pa.Table.from_arrays(columns, schema=schema)
        release()
        return out

    return run


def token_alignment(docs: DataFrame, byte_bpe: str, piece_bpe: str) -> DataFrame:
    """Alignment of each row of ``docs(doc_id, text)``, in numbers and as a digest of its groups.

    ``byte_bpe`` and ``piece_bpe`` are the driver's paths of the two vocabulary
    files; their bytes (some two megabytes) travel with the tasks.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(byte_bpe, "rb") as file_a, open(piece_bpe, "rb") as file_b:
        files = file_a.read(), file_b.read()
    sizes_b = len(Tokenizers(*files).b_bytes)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(texts.mapInArrow(aligner(*files), STORED), "aligned")

    pairs = rows.where("pairs IS NOT NULL").select("batch", "pairs", "counts").mapInArrow(pair_rows(sizes_b), PAIRS)
    totals = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    totals = totals.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))
    found = pairs.join(totals, ["a", "b"]).select("batch", "a", "b", "count", "best")
    per_doc = rows.where("pairs IS NULL").drop("pairs", "counts")
    return per_doc.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(counted(sizes_b), RESULT)
