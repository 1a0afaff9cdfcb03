"""Compact rows for shuffling 48-bit tokens of documents by bucket.

Documents travel in batches.  One row carries all tokens that one batch has
for one bucket: six bytes a token, the step from one token's document to the
next one's, and a rank byte later on.  A document is known by its batch and
its place in it; its 128-bit key and size travel once, in the batch's own row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SCHEMA = "bucket int, batch long, tokens binary, steps binary, ranks binary, keys binary, sizes binary"
ARROW = pa.schema(
    [
        ("bucket", pa.int32()),
        ("batch", pa.int64()),
        *((name, pa.binary()) for name in ("tokens", "steps", "ranks", "keys", "sizes")),
    ]
)
TOKEN_BITS = 48


def pack48(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def bucket_of(values: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Even ranges of the highest 20 of ``bits`` bits."""
    return ((values >> np.uint64(bits - 20)).astype(np.int64) * buckets) >> 20


def table_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, ARROW.types)], schema=ARROW)


def token_row(bucket: int, batch: int, tokens: np.ndarray, places: np.ndarray, ranks: np.ndarray | None) -> tuple:
    """One row; ``places`` are the tokens' documents in the batch, ascending."""
    steps = np.diff(places, prepend=0).astype("<u2").tobytes()
    return bucket, batch, pack48(tokens), steps, b"" if ranks is None else ranks.tobytes(), b"", b""


def deal(batch: int, tokens: np.ndarray, places: np.ndarray, buckets: int) -> list[tuple]:
    """The rows of one batch, by token range."""
    to = bucket_of(tokens, TOKEN_BITS, buckets)
    to = to.astype(np.uint16) if buckets <= 1 << 16 else to
    order = np.argsort(to, kind="stable")
    tokens, places = tokens[order], places[order]
    present, cuts = np.unique(to[order], return_index=True)
    return [
        token_row(b, batch, tokens[x:y], places[x:y], None)
        for b, x, y in zip(present.tolist(), cuts, [*cuts[1:], len(order)])
    ]


@dataclass
class Tokens:
    """The tokens of some rows one after another; ``row`` says which row each is of."""

    batches: np.ndarray
    row: np.ndarray
    tokens: np.ndarray
    places: np.ndarray
    ranks: np.ndarray


def unpack(table: pa.Table) -> Tokens:
    raw = table.column("tokens").to_pylist()
    counts = np.array([len(t) // 6 for t in raw], np.int64)
    tokens = unpack48(b"".join(raw))
    places = np.cumsum(np.frombuffer(b"".join(table.column("steps").to_pylist()), "<u2"), dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    before = np.concatenate([[0], places])[starts]
    places = places - np.repeat(before, counts)
    ranks = np.frombuffer(b"".join(table.column("ranks").to_pylist()), np.uint8)
    return Tokens(table.column("batch").to_numpy(), np.repeat(np.arange(len(counts)), counts), tokens, places, ranks)
