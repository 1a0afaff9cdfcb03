"""Token alignment against a plain version that compares all byte ranges of a text."""

import hashlib
import random
from collections import Counter

import public_tokenizers as files
import pytest

from peerlens.llm import token_alignment as T
from peerlens.llm.queries import QUERIES

PATHS = files.path("byte_bpe_50k.json"), files.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")


@pytest.fixture(scope="module")
def tools():
    return T.Tokenizers(*(open(p, "rb").read() for p in PATHS))


def plain_tokens(tools, text):
    """Whole texts, in one piece, by the libraries' ordinary calls: ``(id, start, end)`` of both sides."""
    if not text:
        return [], []
    whole, out = b" " + text.encode(), []
    byte_of = T.byte_letters()
    for ids, entry in (
        (tools.a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(byte_of[c] for c in tools.a.id_to_token(i))),
        (tools.b.encode(text), lambda i: tools.b_bytes[i]),
    ):
        side, at = [], 0
        for i in ids:
            side.append((i, at, at + len(entry(i))))
            at += len(entry(i))
        if b"".join(entry(i) for i in ids) != whole:
            return [], []
        out.append(side)
    return out


def plain(tools, rows):
    """All pairs of tokens of each text, by their definition."""
    links, overlaps, groups, sizes = [], [], [], []
    for _, text in rows:
        a, b = plain_tokens(tools, text)
        overlaps.append(sum(x[1] < y[2] and y[1] < x[2] for x in a for y in b) if len(a) < 3_000 else None)
        ends = {y[2]: y[0] for y in b}
        links.append([(x[0], ends[x[2]]) for x in a if x[2] in ends])
        text, left = [], 0
        b_at = iter(b)
        for n, x in enumerate(a):
            if x[2] in ends:
                other = []
                for y in b_at:
                    other.append(y[0])
                    if y[2] == x[2]:
                        break
                text.append(",".join(str(z[0]) for z in a[left : n + 1]) + "|" + ",".join(map(str, other)))
                left = n + 1
        groups.append(text)
        sizes.append((len(a), len(b)))
    count = Counter(pair for one in links for pair in one)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [
        (
            row[0], *size, len(group), len(one), sum(count[p] == best[p[1]] for p in one), sum(count[p] for p in one),
            hashlib.sha256(";".join(group).encode()).hexdigest() if size[0] else "", over,
        )
        for row, size, group, one, over in zip(rows, sizes, groups, links, overlaps)
    ]


def order(row):
    return tuple((v is None, v or 0) for v in row[:1]) + tuple(map(str, row[1:]))


def same(found, expected):
    found, expected = (sorted((tuple(r) for r in rows), key=order) for rows in (found, expected))
    assert len(found) == len(expected)
    for x, y in zip(found, expected):
        assert x[:-1] == y[:-1] and y[-1] in (None, x[-1])


def test_equals_all_pairs(spark, tools):
    rng = random.Random(5)
    letters = "aé ß日本😀 \n\t'sZ09<>_. ▁"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(1000, "the end of the story " * 90), (1001, "<|endoftext|> <s> </s> <unk> <0x41>"), (1002, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(T.token_alignment(docs, *PATHS).select(*COLUMNS).collect(), plain(tools, rows))


def test_edge_rows(spark, tools, edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    found = T.token_alignment(edge_docs, *PATHS).select(*COLUMNS).collect()
    same(found, plain(tools, rows))
    zero = [r for r in found if r.doc_id in (1, 2)]
    assert [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in zero] == [
        (0, 0, 0, 0, 0, 0, "")
    ] * 2


def test_no_documents(spark, no_docs):
    assert T.token_alignment(no_docs, *PATHS).collect() == []


def test_a_text_of_megabytes_is_cut_without_a_trace(spark, tools):
    rng = random.Random(8)
    text = " ".join(rng.choice(["word", "naïve", "x.y", "\n", "  ", "日本語", "it's"]) + str(rng.randrange(99)) for _ in range(120_000))
    assert len(T.segments(text)) > 10
    assert " ".join(T.segments(text)) == text
    rows = [(1, text), (2, "▁" + text), (3, "no" * 70_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(T.token_alignment(docs, *PATHS).select(*COLUMNS).collect(), plain(tools, rows))


def test_merge_asof_finds_every_overlap(tools):
    rng = random.Random(2)
    for _ in range(50):
        total = rng.randrange(1, 40)
        sides = []
        for _ in "ab":
            cuts = sorted(rng.sample(range(1, total), rng.randrange(total))) if total > 1 else []
            sides.append([y - x for x, y in zip([0, *cuts], [*cuts, total])])
        sizes = T.np.arange(41)
        a, b = (T.placed(T.np.array(x), T.np.array([len(x)]), T.np.zeros(1, int), sizes) for x in sides)
        found = {(r.token_a, r.token_b) for r in T.overlapping(a, b).itertuples()}
        assert len(found) == len(T.overlapping(a, b))
        assert found == {
            (x.token, y.token) for x in a.itertuples() for y in b.itertuples() if x.at < y.end and y.at < x.end
        }


def test_words_are_forgotten_without_a_trace(spark, tools, monkeypatch):
    monkeypatch.setattr(T, "KNOWN_WORDS", 50)
    monkeypatch.setattr(T, "BLOCK", 1 << 10)
    rows = [(i, " ".join(f"w{i * j}" for j in range(60))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    same(T.token_alignment(docs, *PATHS).select(*COLUMNS).collect(), plain(tools, rows))


def test_words_used_most_stay_known(tools, monkeypatch):
    monkeypatch.setattr(T, "KNOWN_WORDS", 50)
    encoder, encoded = T.Encoder(tools), []
    encode = tools.encode
    monkeypatch.setattr(tools, "encode", lambda words: encoded.extend(words) or encode(words))
    texts = [" ".join(["often"] * 3 + ["bad▁often"] + [f"w{i}x{j}" for j in range(30)]) for i in range(20)]
    for text in texts:
        a, b, sound = encoder.tokens([text, "often seen"])
        assert sound.tolist() == [False, True]
        assert [a["id"].tolist(), b["id"].tolist()] == [[i for i, _, _ in side] for side in plain_tokens(tools, "often seen")]
        assert len(encoder.place) <= 50 + 32
    assert encoded.count("often") == 1 and encoded.count("seen") < 4


def test_given_back_tells_bytes_and_not_only_lengths():
    table = [b"", b" a", b"b", b"cd"]
    sizes = T.np.array([len(x) for x in table])
    ids = [[1, 2], [1], [1, 3], [], [1, 2, 2], [3, 2]]
    whole = [b" ab", b" ab", b" abc", b"", b" aba", b"cdb"]
    assert T.given_back(ids, table, sizes, whole).tolist() == [True, False, False, True, False, True]
    assert T.given_back([], table, sizes, []).tolist() == []


def test_one_pair_in_all_documents(spark, tools):
    rows = [(i, "the" if i % 3 else f"the {i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    same(T.token_alignment(docs, *PATHS).select(*COLUMNS).collect(), plain(tools, rows))


def test_query(spark, small, tools):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    found = QUERIES["op11_token_alignment"](spark, small)
    assert found.columns[:8] == list(COLUMNS[:8])
    same(found.select(*COLUMNS).collect(), plain(tools, rows))
