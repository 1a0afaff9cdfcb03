"""Personal data against a plain version: the rules as given, the graph with dictionaries."""

import hashlib
import random
import re
import time
from collections import defaultdict

from peerlens.llm import personal_data as P
from peerlens.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SLOT = "|".join(
    (PLAIN["phone"], r"(?<![A-Za-z0-9._%+-])" + PLAIN["email"], "(?<![0-9])" + PLAIN["ip"], r"[0-9]{12,}",
     r"\(?[0-9]{1,6}([\x20().-]{1,2}[0-9]{1,6})+", r"(?<![A-Za-z0-9._%@-])[A-Za-z._%-]*[0-9@][A-Za-z0-9._%@-]*")
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def luhn(number):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in number])):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def kept(kind, text):
    number = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        return 16 <= len(number) <= 19 and luhn(number)
    return kind == "email" or 8 <= len(number) <= 15


def kind_of(text):
    return next((k for k, p in PLAIN.items() if re.fullmatch(p, text) and kept(k, text)), None)


def may_be(kind, text):
    n = len(re.sub("[^0-9]", "", text))
    if kind == "email":
        return text.count("@") == 1 and not text.startswith("@") and not text.endswith("@")
    if kind == "ip":
        return bool(re.fullmatch(PLAIN["ip"], text))
    if kind == "card":
        return 12 <= n <= 19 and bool(re.fullmatch(PLAIN["card"], text))
    return 7 <= n <= 15 and bool(re.fullmatch(r"[+(]?[0-9][\x20().0-9-]+", text))


def rules(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text, re.A) if kept(k, m[0])]


def candidates(text):
    """``(start, end, string, patterns)``."""
    found = list(re.finditer(SLOT, text))
    for i, m in enumerate(found):
        low, high = found[i - 1].end() if i else 0, found[i + 1].start() if i + 1 < len(found) else len(text)
        left = WORD.findall(text[low : m.start()][-64:].translate(SMALL))
        right = WORD.findall(text[m.end() : high][:64].translate(SMALL))
        patterns = {f"{left[-2]} {left[-1]} _"} if len(left) > 1 else set()
        if left and right:
            patterns.add(f"{left[-1]} _ {right[0]}")
        bare = m[0].strip("._%-")
        start = m.start() + len(m[0]) - len(m[0].lstrip("._%-"))
        if bare:
            yield start, start + len(bare), bare, patterns


def learn(texts):
    graph, seeds = defaultdict(set), {}
    for text in texts:
        for _, _, string, patterns in candidates(text):
            seeds[string] = kind_of(string)
            for p in patterns:
                graph[p].add(string)
    learned = {}
    for _ in range(3):
        label = {s: k or learned.get(s) for s, k in seeds.items()}
        doubt = defaultdict(lambda: 1.0)
        for strings in graph.values():
            for kind in PLAIN:
                pos = sum(label[s] == kind for s in strings)
                neg = sum(label[s] != kind if label[s] else not may_be(kind, s) for s in strings)
                confidence = pos / (pos + neg + 1.0)
                if pos >= 3 and confidence >= 0.7:
                    for s in strings:
                        if seeds[s] is None and may_be(kind, s):
                            doubt[s, kind] *= 1 - confidence
        learned = {}
        for (s, kind), d in doubt.items():
            trust = round(1 - d, 6)
            best = learned.get(s)
            if trust >= 0.9 and (best is None or (-trust, list(PLAIN).index(kind)) < best[0]):
                learned[s] = ((-trust, list(PLAIN).index(kind)), kind)
        learned = {s: kind for s, (_, kind) in learned.items()}
    return seeds, learned


def written(spans):
    return ",".join(":".join(map(str, s)) for s in sorted(spans, key=lambda s: (list(PLAIN).index(s[0]), s[1], s[2])))


def plain(rows):
    seeds, learned = learn([t or "" for _, t in rows])
    out = []
    for doc, text in rows:
        base = rules(text or "")
        more = [
            (kind, start, end)
            for start, end, string, _ in candidates(text or "")
            if (kind := seeds[string] or learned.get(string)) and not any(s < end and start < e for _, s, e in base)
        ]
        n = [sum(b[0] == k for b in base) for k in PLAIN]
        digest = hashlib.sha256(written(base).encode()).hexdigest()
        out.append((doc, *n, digest, written([*base, *more]), len(more)))
    return out


def order(row):
    return tuple(map(str, row))


def same(found, expected):
    assert sorted(map(tuple, found), key=order) == sorted(expected, key=order)


def run(spark, rows):
    return P.personal_data(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()


def card(rng):
    body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(body + d for d in "0123456789" if luhn(body + d))


def test_rules_on_random_texts(spark):
    rng = random.Random(7)
    parts = ["a", "b.c", "@", ".", "1", "12", "255", "256", "300", "+", "+1", "(", ")", "-", " ", "_", "%", "é", "😀", "\n", "4111 1111 1111 1111",
             "4111111111111111", "x@y.z", "1.2.3.4", "+1 (743) 555-3824", "007.1.02.0003"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(25)))) for i in range(1_500)]
    same(run(spark, rows), plain(rows))


def learned_rows(rng):
    """Phones without a plus, a card that does not add up and an odd address in contexts that seeds share."""
    words = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam".split()
    text = lambda: " ".join(rng.choices(words, k=12))
    rows = []
    for _ in range(12):
        phone = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        rows.append(f"{text()} please call me at {phone} today, {text()}")
        rows.append(f"{text()} my card number is {card(rng)} and {text()}")
        rows.append(f"{text()} write to: user{rng.randrange(999)}@mail.example.com please {text()}")
        rows.append(f"{text()} in the year {rng.randrange(1900, 2030)} and {text()}")
        rows.append(f"{text()} order {rng.randrange(10**9, 10**10)} was {text()}")
    rows.append(f"{text()} please call me at 743-555-3824 today, {text()}")
    rows.append(f"{text()} my card number is 4111111111111112 and {text()}")
    rows.append(f"{text()} write to: root@localhost please {text()}")
    rows.append(f"{text()} again 743-555-3824 {text()}")
    same_card = card(rng)
    rows += [f"{text()} {same_card} {same_card} {text()}", f"{text()} {same_card} {text()}"]
    return list(enumerate(rows)), same_card


def test_contexts_find_what_no_rule_knows(spark):
    rows, same_card = learned_rows(random.Random(3))
    found = {r.doc_id: r for r in run(spark, rows)}
    same(found.values(), plain(rows))

    def added(of):
        return [text[int(s) : int(e)] for d, text in rows if of in text and found[d].n_added
                for _, s, e in (x.split(":") for x in found[d].spans.split(","))]

    assert added("743-555-3824") == ["743-555-3824"] * 2
    assert added("4111111111111112") == ["4111111111111112"]
    assert added("root@localhost") == ["root@localhost"]
    assert added(f"{same_card} {same_card}") == [same_card] * 2
    assert not any(found[d].spans for d, text in rows if " year " in text or " order " in text)


def test_copies_do_not_make_a_pattern_surer(spark):
    """A third of all rows repeat one text: its instance counts once."""
    rows = [(i, "please call me at +1 743 555 3824 today") for i in range(300)]
    rows += [(1000 + i, f"nothing {i}") for i in range(300)] + [(5000, "please call me at 743-555-9999 today")]
    found = run(spark, rows)
    same(found, plain(rows))
    assert sum(r.n_added for r in found) == 0


def test_edge_rows(spark, edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    same(P.personal_data(edge_docs).collect(), plain(rows))


def test_no_documents(spark, no_docs):
    assert P.personal_data(no_docs).collect() == []


def test_long_runs_take_linear_time(spark):
    parts = ["a", "1", "a.", "1.", "1 ", "+1", "+1 ", "a@", "a@b.", "(1", "-", "é", "1-1a", "1.1.1.1a", "a@b.c_"]
    docs = spark.createDataFrame([(i, p * 100_000) for i, p in enumerate(parts)], "doc_id long, text string")
    start = time.time()
    found = {parts[r.doc_id]: r for r in P.personal_data(docs.repartition(8)).collect()}
    assert time.time() - start < 60
    assert found["1."].n_ip == 25_000 and found["a@b."].n_email == 50_000 and found["a@b.c_"].n_email == 100_000
    assert found["1.1.1.1a"].n_ip == 100_000 and not found["a"].spans


def test_no_python_in_the_plan(spark, small):
    plan = QUERIES["op13_contextual_personal_data"](spark, small)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_query(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    same(QUERIES["op13_contextual_personal_data"](spark, small).collect(), plain(rows))
