"""Language of each word and text by a linear-chain conditional random field.

Words are runs of letters.  The field scores each word by its affixes, byte
n-grams and a lexicon of frequent words, and neighbouring words by learned
transitions; forward-backward gives every word's probabilities, so a text
that switches language half way is read as such.  A text's language is the
one with the highest mean over its distinct words, each with the mean of its
occurrences, so that a line repeated a thousand times does not outvote the rest.

Training uses a bounded sample of labelled rows (``docs_per_language`` texts of
at most ``max_bytes`` each, chosen by a hash of the id).  Its texts are cut into
spans, and spans of all languages are strung together in a seeded order, so
that transitions are learned from sequences which do switch.  Scoring reads
every whole text and keeps no state between rows; a long text is one sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerlens.llm.store import small_batches
from peerlens.llm.words import LOWER, U64, Texts, mix, texts_of

SLOTS = 1 << 16
LEXICON = 300
SEQUENCE = 64
ROUNDS = 40
SEED = 11
GROUP_WORDS = 1 << 20

_bytes = np.arange(256)
IS_LETTER = (_bytes >= 128) | ((_bytes >= 65) & (_bytes <= 90)) | ((_bytes >= 97) & (_bytes <= 122))
# Every byte that is not of a letter run becomes a space; words are then cut as usual.
ONLY_LETTERS = np.where(IS_LETTER, LOWER, 32).astype(np.uint8)


def letter_runs(texts: Texts) -> Texts:
    return Texts(ONLY_LETTERS[texts.raw], texts.bounds, texts.row)


@dataclass
class Grams:
    """Feature slots of some words: 2- and 3-grams word by word, and one 4-gram at either end."""

    two: np.ndarray
    two_at: np.ndarray
    three: np.ndarray
    three_at: np.ndarray
    ends: np.ndarray  # (words, 2), slot 0 where the word is too short


def grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Grams:
    """The word's bytes between two marks; grams with a mark are its affixes."""
    wide = ends - starts + 2
    first = np.concatenate([[0], np.cumsum(wide)])
    place = np.arange(first[-1]) - np.repeat(first[:-1], wide)
    source = np.repeat(starts - 1, wide) + place
    letters = data[np.clip(source, 0, len(data) - 1)].astype(U64)
    letters[first[:-1]] = 1
    letters[first[1:] - 1] = 2

    def slots(n: int, at: np.ndarray) -> np.ndarray:
        code = np.full(len(at), n, U64)
        for k in range(n):
            code = code * U64(257) + letters[at + k]
        return (mix(code) % U64(SLOTS - 1)).astype(np.int64) + 1

    def everywhere(n: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(place + n <= np.repeat(wide, wide))
        return slots(n, at), np.concatenate([[0], np.cumsum(wide - n + 1)])[:-1]

    edge = np.zeros((len(starts), 2), np.int64)
    long = np.flatnonzero(wide >= 4)
    edge[long, 0] = slots(4, first[long])
    edge[long, 1] = slots(4, first[long + 1] - 4)
    return Grams(*everywhere(2), *everywhere(3), edge)


@dataclass
class Model:
    """Learned weights; ``languages`` in code point order."""

    languages: list[str]
    weights: np.ndarray  # (SLOTS, languages), row 0 stays 0
    lexicon: np.ndarray  # word hashes, sorted
    lexical: np.ndarray  # (len(lexicon) + 1, languages), the last row stays 0
    transitions: np.ndarray  # log scale
    start: np.ndarray

    def lookup(self, words: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.lexicon, words)
        at[at == len(self.lexicon)] = 0
        return np.where(self.lexicon[at] == words, at, len(self.lexicon)) if len(self.lexicon) else at

    def scores(self, g: Grams, in_lexicon: np.ndarray) -> np.ndarray:
        out = np.add.reduceat(self.weights[g.two], g.two_at, axis=0)
        out += np.add.reduceat(self.weights[g.three], g.three_at, axis=0)
        return out + self.weights[g.ends].sum(axis=1) + self.lexical[in_lexicon]

    def word_scores(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all words of some texts, equal words scored once, and 1 / (how often the text has the word)."""
        words = texts.word_hash()
        distinct, where, back = np.unique(words, return_index=True, return_inverse=True)
        g = grams(texts.data, texts.starts[where], texts.ends[where])
        place = texts.text_of_word() * len(distinct) + back
        _, same, often = np.unique(place, return_inverse=True, return_counts=True)
        return self.scores(g, self.lookup(distinct))[back].astype(np.float32), 1 / often[same]


def posteriors(scores: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    """Forward-backward over each sequence; all sequences advance together, the longest first."""
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    base, lengths = first[:-1][order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right")
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(model.transitions - model.transitions.max()).astype(np.float32)
    ahead = np.empty_like(emit)
    for t in range(steps):
        at = base[: active[t]] + t
        a = emit[at] * (a[: active[t]] @ move if t else np.exp(model.start).astype(np.float32))
        a /= a.sum(axis=1, keepdims=True)
        ahead[at] = a
    behind = np.ones((len(base), scores.shape[1]), np.float32)
    for t in range(steps - 1, -1, -1):
        m = active[t]
        at = base[:m] + t
        b = behind[:m]
        joint = ahead[at] * b
        ahead[at] = joint / joint.sum(axis=1, keepdims=True)
        b = (emit[at] * b) @ move.T
        behind[:m] = b / b.sum(axis=1, keepdims=True)
    return ahead


def _learn_step(model: Model, spread: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected minus observed counts of labels per position, transitions and starts.

    ``spread`` is (sequences, SEQUENCE, languages).
    """
    n, steps, k = spread.shape
    move, emit = np.exp(model.transitions), np.exp(spread - spread.max(axis=2, keepdims=True))
    ahead, behind = np.empty_like(emit), np.ones_like(emit)
    for t in range(steps):
        a = emit[:, t] * (ahead[:, t - 1] @ move if t else np.exp(model.start))
        ahead[:, t] = a / a.sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        b = (emit[:, t + 1] * behind[:, t + 1]) @ move.T
        behind[:, t] = b / b.sum(axis=1, keepdims=True)
    expected = ahead * behind
    expected /= expected.sum(axis=2, keepdims=True)
    pairs = ahead[:, :-1, :, None] * move * (emit[:, 1:] * behind[:, 1:])[:, :, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    moved = pairs.sum(axis=(0, 1)) - np.bincount(
        (gold[:, :-1] * k + gold[:, 1:]).ravel(), minlength=k * k
    ).reshape(k, k)
    expected[np.arange(n)[:, None], np.arange(steps), gold] -= 1
    return expected, moved, expected[:, 0].sum(axis=0)


def train(texts: list[str], labels: list[str], rounds: int = ROUNDS, decay: float = 0.1) -> Model:
    """Fit the field by full-batch AdaGrad on spans strung together in a seeded order."""
    languages = sorted(set(labels))
    k = len(languages)
    hashes, pieces, spans = [], [], []
    offset = 0
    for block in texts_of(pa.array(texts, pa.large_string())):
        runs = letter_runs(block)
        hashes.append(runs.word_hash())
        pieces.append([runs.data[a:b].tobytes() for a, b in zip(runs.starts, runs.ends)])
        label = [languages.index(x) for x in labels[block.row : block.row + block.rows]]
        spans += [(offset + a, offset + b, y) for a, b, y in zip(runs.first[:-1], runs.first[1:], label)]
        offset += len(runs)
    words = np.concatenate(hashes) if hashes else np.zeros(0, U64)
    names = [w for part in pieces for w in part]
    rng = np.random.default_rng(SEED)
    cut: list[tuple[int, int, int]] = []
    for a, b, y in spans:
        while a < b:
            to = min(b, a + int(rng.integers(6, 40)))
            cut.append((a, to, y))
            a = to
    model = Model(
        languages, np.zeros((SLOTS, k), np.float32), np.zeros(0, U64), np.zeros((1, k), np.float32),
        np.zeros((k, k)), np.zeros(k),
    )
    order = rng.permutation(len(cut))
    stream = np.concatenate([np.arange(cut[o][0], cut[o][1]) for o in order]) if cut else np.zeros(0, np.int64)
    gold = np.concatenate([np.full(cut[o][1] - cut[o][0], cut[o][2]) for o in order]) if cut else stream
    n = len(stream) // SEQUENCE
    if k < 2 or not n:
        return model
    stream, gold = stream[: n * SEQUENCE], gold[: n * SEQUENCE].reshape(n, SEQUENCE)
    distinct, where, back = np.unique(words[stream], return_index=True, return_inverse=True)
    used = [names[i] for i in stream[where]]
    length = np.array([len(w) for w in used])
    ends = np.cumsum(length)
    g = grams(np.frombuffer(b"".join(used), np.uint8), ends - length, ends)
    per_language = np.stack([np.bincount(back[gold.ravel() == y], minlength=len(distinct)) for y in range(k)])
    top = np.unique(np.argsort(-per_language, axis=1, kind="stable")[:, :LEXICON])
    top = top[per_language[:, top].sum(axis=0) > 2]
    model.lexicon = distinct[top]
    model.lexical = np.zeros((len(top) + 1, k), np.float32)
    in_lexicon = model.lookup(distinct)

    two_owner = np.repeat(np.arange(len(length)), length + 1)
    three_owner = np.repeat(np.arange(len(length)), length)
    slot = np.concatenate([g.two, g.three, g.ends[:, 0], g.ends[:, 1]])
    owner = np.concatenate([two_owner, three_owner, np.arange(len(length)), np.arange(len(length))])
    by_slot = np.argsort(slot, kind="stable")
    slot, owner = slot[by_slot], owner[by_slot]
    slots, slot_at = np.unique(slot, return_index=True)

    seen = {"weights": 1e-8, "lexical": 1e-8, "transitions": 1e-8, "start": 1e-8}
    for _ in range(rounds):
        spread = model.scores(g, in_lexicon)[back].astype(np.float64).reshape(n, SEQUENCE, k)
        excess, moved, began = _learn_step(model, spread, gold)
        flat = excess.reshape(-1, k)
        by_word = np.stack([np.bincount(back, flat[:, y], minlength=len(distinct)) for y in range(k)], axis=1)
        grad = {
            "weights": np.zeros_like(model.weights, dtype=np.float64),
            "lexical": np.zeros(model.lexical.shape),
            "transitions": moved,
            "start": began,
        }
        grad["weights"][slots] = np.add.reduceat(by_word[owner], slot_at, axis=0)
        np.add.at(grad["lexical"], in_lexicon, by_word)
        for name, step in grad.items():
            value = getattr(model, name)
            step = step + decay * value
            seen[name] = seen[name] + step * step
            setattr(model, name, (value - 0.3 * step / np.sqrt(seen[name])).astype(value.dtype))
        model.weights[0], model.lexical[-1] = 0, 0
    return model


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def predict(model: Model, passed: list[str]):
    """Map function: the columns ``passed`` and ``lang_pred``, ``score`` of each row."""

    def summed(scores: list[tuple[np.ndarray, np.ndarray]], counts: list[np.ndarray]) -> np.ndarray:
        first = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        words = posteriors(np.concatenate([s[0] for s in scores]), first, model)
        weight = np.concatenate([s[1] for s in scores])
        total = np.zeros((len(words) + 1, words.shape[1] + 1))
        np.cumsum(words * weight[:, None], axis=0, out=total[1:, :-1])
        np.cumsum(weight, out=total[1:, -1])
        share = total[first[1:]] - total[first[:-1]]
        return np.clip(share[:, :-1] / np.maximum(share[:, -1:], 1e-9), 0.0, 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shares, scores, counts, held, ascii_letter = [], [], [], 0, []
            column = batch.column("text")
            for texts in texts_of(column):
                runs = letter_runs(texts)
                letters = np.concatenate([[0], np.cumsum((runs.data >= 97) & (runs.data <= 122))])
                ascii_letter.append(np.diff(letters[runs.bounds]) > 0)
                if len(runs):
                    scores.append(model.word_scores(runs))
                else:
                    scores.append((np.zeros((0, len(model.languages)), np.float32), np.zeros(0)))
                counts.append(runs.counts())
                held += len(runs)
                if held >= GROUP_WORDS:
                    shares.append(summed(scores, counts))
                    scores, counts, held = [], [], 0
            if counts:
                shares.append(summed(scores, counts))
            share = np.concatenate(shares) if shares else np.zeros((0, len(model.languages)))
            best = share.argmax(axis=1)
            top = share[np.arange(len(best)), best]
            plain = np.concatenate(ascii_letter) if ascii_letter else []
            known = [bool(a) or (s > 0 and has_letter(t.as_py())) for a, s, t in zip(plain, top, column)]
            names = [model.languages[b] if k else "und" for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in passed],
                    pa.array(names, pa.string()),
                    pa.array(np.clip(np.where(known, top, 0.0), 0.0, 1.0)),
                ],
                names=[*passed, "lang_pred", "score"],
            )

    return run


def fit(
    labelled: DataFrame, docs_per_language: int = 128, max_bytes: int = 65_536, max_languages: int = 200
) -> Model:
    """Train on ``labelled(doc_id, text, lang)``: at most ``docs_per_language`` texts of each language.

    Ids are drawn before texts are fetched; a row that repeats counts once.
    """
    small_batches(labelled.sparkSession)
    bound = docs_per_language * max_languages
    usable = (
        labelled.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
        .where(F.octet_length("text") <= max_bytes)
        .select("lang", "doc_id", "text", F.xxhash64("text").alias("digest"))
    )
    rank = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "digest")
    drawn = (
        usable.select("lang", "doc_id", "digest")
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= docs_per_language)
        .groupBy("lang", "doc_id", "digest")
        .agg(F.min("rank").alias("rank"))
        .limit(bound + 1)
    )
    sample = usable.join(F.broadcast(drawn), ["lang", "doc_id", "digest"]).groupBy("lang", "rank").agg(F.min("text").alias("text"))
    rows = sorted((r.lang, r.rank, r.text) for r in sample.collect())
    if len({lang for lang, _, _ in rows}) > max_languages:
        raise ValueError(f"more than {max_languages} languages are labelled")
    return train([text for _, _, text in rows], [lang for lang, _, _ in rows])


def held_out(remainder: int, modulus: int) -> Column:
    """Whether a row is kept from training: crc32 of its id as text; rows without an id are not."""
    return F.coalesce(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False)
    )


def language_of(docs: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of each row of ``docs(doc_id, text, lang)``.

    The field is fitted on ``training`` (by default ``docs``) without the held
    out rows.  ``und`` with score 0 stands for texts that are null, empty or
    without a letter, and for all rows if no row is labelled.
    """
    known = (docs if training is None else training).select("doc_id", F.col("text").cast("string"), "lang")
    model = fit(known.where(~held_out(2, 4)))
    rows = docs.select(F.col("doc_id").cast("long"), held_out(2, 4).alias("held_out"), F.col("text").cast("string"))
    if not model.languages:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(predict(model, ["doc_id", "held_out"]), PREDICTED)


def in_known_language(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``least`` or more; the columns stay.

    The text and the labels are read from ``doc_id``, ``text`` and ``lang``; if no
    row is labelled, no language is known and no row stays.
    """
    model = fit(docs.select("doc_id", F.col("text").cast("string"), "lang").where(~held_out(2, 4)))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text")
    )
    if not model.languages:
        return docs.limit(0)
    kind = rows.schema["row"].dataType.simpleString()
    judged = rows.mapInArrow(predict(model, ["row"]), f"row {kind}, lang_pred string, score double")
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("row.*")
