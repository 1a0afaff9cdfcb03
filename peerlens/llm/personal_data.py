r"""Personal data by fixed rules, and more of it by the contexts that these share.

The rules find emails, IPv4 addresses, card and phone numbers; what they find
stays.  Bootstrapping adds to it.  Anything in a text that looks like a number
or an address is a candidate.  A candidate that as a string satisfies a rule is
a seed.  Each candidate stands in lexical patterns: the two words before it,
and the word before with the word behind.  Patterns and instances form a graph
that is scored ``ROUNDS`` times:

* a pattern's confidence for a kind is pos / (pos + neg + 1), its distinct
  instances of that kind against those of another kind or that cannot be of
  this one; unlabelled ones that may be are neutral;
* an instance's trust is 1 - product(1 - confidence) over its patterns with at
  least ``LEAST_SEEDS`` instances of the kind and ``PATTERN`` confidence; from
  ``INSTANCE`` trust on it has the kind, and counts for patterns in the next
  round.

Every place of an instance with a kind is a span, unless it overlaps one of the
rules'.  Everything is built-in functions.  Texts are read once; what goes on
is a row per candidate, and only numbers, contexts of at most 64 characters and
the candidates themselves are shuffled.  Hot patterns and instances are dealt
out over ``SALTS`` parts of each join.

Null and empty texts have no spans (the digest is that of the empty text).
Repeated rows each have their own result, and count once in the graph.  The
patterns for Java are written so that no text takes more than linear time: a
run of letters is tried from its start alone (``\G`` stands for the end of the
last match), and nothing inside it is tried again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerlens.llm.store import stored

KINDS = ("email", "ip", "card", "phone")
CANDIDATE = len(KINDS)
ROUNDS, LEAST_SEEDS, PATTERN, INSTANCE = 3, 3, 0.7, 0.9
SALTS, CONTEXT = 16, 64

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
RULES = (EMAIL, IP, CARD, PHONE)
NUMBER = r"[0-9]{12,}+|\(?[0-9]{1,6}(?:[\x20().-]{1,2}[0-9]{1,6})++"
TOKEN = r"(?<![A-Za-z0-9._%@-])[A-Za-z._%-]*+[0-9@][A-Za-z0-9._%@-]*+"
# A candidate does not go on where one has ended: what is left of a run would be read again after each.
SLOT = "|".join((PHONE, EMAIL, IP, NUMBER, TOKEN)).replace(r"\G|", "")
WORD = r"[^\x20\x09-\x0D]+"

BYTE_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
SOUND_IP = rf"^{BYTE_PART}(?:\.{BYTE_PART}){{3}}$"
WHOLE = tuple("^(?:" + rule.replace(r"(?:\G|(?<![A-Za-z0-9._%+-]))", "") + ")$" for rule in RULES)
WHOLE_IP = r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"
LOOSE = (r"^[^@]+@[^@]+$", WHOLE_IP, r"^[0-9](?:[\x20-]?[0-9])++$", r"^[+(]?[0-9][\x20().0-9-]+$")


def digits(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^0-9]", ""))


def luhn(text: Column) -> Column:
    """Whether the digits of a card number, 19 at most, add up."""
    plain = F.reverse(F.right(F.translate(text, " -", ""), F.lit(19)))

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(plain, place, F.lit(1)).cast("int") * (F.lit(2) - place % 2)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(plain)), F.lit(0), add) % 10 == 0


def sound(kind: int, match: Column) -> Column:
    """Whether what a rule has matched is kept."""
    if kind == 1:
        return match.rlike(SOUND_IP)
    if kind == 2:
        return digits(match).between(16, 19) & luhn(match)
    if kind == 3:
        return digits(match).between(8, 15)
    return F.lit(True)


def seed_kind(text: Column) -> Column:
    """The kind that a whole string is by the rules, null if none."""
    whole = (WHOLE[0], WHOLE_IP, WHOLE[2], WHOLE[3])
    return reduce(
        lambda otherwise, k: F.when(F.when(text.rlike(whole[k]), sound(k, text)), k).otherwise(otherwise),
        reversed(range(len(KINDS))),
        F.lit(None).cast("int"),
    )


def may_be(kind: int, text: Column) -> Column:
    """Whether a string has the form of a kind, if not all that the rule asks for."""
    low, high = {2: (12, 19), 3: (7, 15)}.get(kind, (0, None))
    fits = text.rlike(LOOSE[kind])
    return fits & digits(text).between(low, high) if high else fits


def items(kind: int) -> Column:
    """What one pattern finds in a text: the length of the gap before each match, and the match.

    Of a candidate, its contexts; of what a rule matches, whether it is kept.
    Matches and the gaps around them are zipped: a lambda that took them by
    place from the arrays could make these anew for every match.
    """
    found, gaps = F.col(f"found{kind}"), F.col(f"gaps{kind}")
    candidate, null = kind == CANDIDATE, F.lit(None).cast("string")

    def item(match: Column, before: Column, behind: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            F.length(before).alias("gap"),
            F.length(match).alias("size"),
            (F.lit(True) if candidate else sound(kind, match)).alias("kept"),
            (match if candidate else null).alias("match"),
            (F.right(before, F.lit(CONTEXT)) if candidate else null).alias("before"),
            (F.left(behind, F.lit(CONTEXT)) if candidate else null).alias("behind"),
        )

    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(m.alias("m"), g.alias("g")))
    if not candidate:
        return F.transform(pairs, lambda p: item(p["m"], p["g"], null))
    return F.zip_with(pairs, F.slice(gaps, 2, F.size(found)), lambda p, behind: item(p["m"], p["g"], behind))


def matched(docs: DataFrame) -> DataFrame:
    """``(uid, doc_id, items)``: all that the rules and the candidates' pattern match, stored."""
    texts = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    patterns = dict(enumerate([*RULES, SLOT]))
    none = F.array().cast("array<string>")
    # A text without a digit or an at sign has nothing to find.
    some = F.col("text").rlike("[0-9@]")
    all_of = lambda p: F.when(some, F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none)
    around = lambda k, p: F.when(F.size(f"found{k}") > 0, F.split("text", p, -1)).otherwise(none)
    found = texts.select("*", *(all_of(p).alias(f"found{k}") for k, p in patterns.items()))
    cut = found.select("*", *(around(k, p).alias(f"gaps{k}") for k, p in patterns.items()))
    return stored(cut.select("uid", "doc_id", F.concat(*map(items, patterns)).alias("items")), "matches")


def placed(found: DataFrame) -> DataFrame:
    """One row a match that counts, with its first and the character behind its last; candidates trimmed."""
    rows = found.select("uid", F.posexplode("items").alias("place", "item")).select("uid", "place", "item.*")
    so_far = Window.partitionBy("uid", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap").cast("long") + F.col("size")).over(so_far)
    rows = rows.select("*", (end - F.col("size")).alias("start")).where("kept")
    front = F.regexp_replace("match", "^[._%-]++", "")
    bare = F.regexp_replace(front, "(?<![._%-])[._%-]++$", "")
    candidate = F.col("kind") == CANDIDATE
    start = F.col("start") + F.when(candidate, F.col("size") - F.length(front)).otherwise(0)
    size = F.when(candidate, F.length(bare)).otherwise(F.col("size"))
    out = rows.select(
        "uid", "kind", start.alias("start"), (start + size).alias("end"), F.when(candidate, bare).alias("instance"), "before", "behind"
    )
    return stored(out, "places")


def edges_of(places: DataFrame) -> DataFrame:
    """``(pattern, instance, seed, may0..may3)``: which instances stand in which patterns, each once."""
    lower = "abcdefghijklmnopqrstuvwxyz"
    small = lambda c: F.translate(F.col(c), lower.upper(), lower)
    words = places.where((F.col("kind") == CANDIDATE) & (F.col("instance") != "")).select(
        "instance",
        F.regexp_extract_all(small("before"), F.lit(WORD), F.lit(0)).alias("left"),
        F.regexp_extract_all(small("behind"), F.lit(WORD), F.lit(0)).alias("right"),
    )
    last, last_but_one, first = F.get("left", F.size("left") - 1), F.get("left", F.size("left") - 2), F.get("right", F.lit(0))
    patterns = F.array(
        F.when(F.size("left") > 1, F.concat(last_but_one, F.lit(" "), last, F.lit(" _"))),
        F.when((F.size("left") > 0) & (F.size("right") > 0), F.concat(last, F.lit(" _ "), first)),
    )
    rows = words.select("instance", F.explode(patterns).alias("pattern")).where("pattern IS NOT NULL").distinct()
    instance = F.col("instance")
    return rows.select(
        "pattern", "instance", seed_kind(instance).alias("seed"), *(may_be(k, instance).alias(f"may{k}") for k in range(len(KINDS)))
    )


def dealt_join(many: DataFrame, few: DataFrame, key: str, by: str, how: str) -> DataFrame:
    """``many`` joined with ``few`` on ``key``; rows of a hot key go to ``SALTS`` parts, by their ``by``."""
    left = many.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)))
    right = few.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return left.join(right, [key, "salt"], how).drop("salt")


def confidences(labelled: DataFrame) -> DataFrame:
    """``(pattern, of, confidence)`` of the patterns that are sure enough of a kind."""
    label, kinds = F.col("label"), range(len(KINDS))
    other = lambda k: F.coalesce(label != k, ~F.col(f"may{k}"))
    counts = labelled.groupBy("pattern").agg(
        *(F.count_if(label == k).alias(f"pos{k}") for k in kinds), *(F.count_if(other(k)).alias(f"neg{k}") for k in kinds)
    )
    each = [F.struct(F.lit(k).alias("of"), F.col(f"pos{k}").alias("pos"), F.col(f"neg{k}").alias("neg")) for k in kinds]
    rows = counts.select("pattern", F.explode(F.array(*each)).alias("s")).select("pattern", "s.*").where(F.col("pos") >= LEAST_SEEDS)
    confidence = F.col("pos") / (F.col("pos") + F.col("neg") + F.lit(1.0))
    return rows.select("pattern", "of", confidence.alias("confidence")).where(F.col("confidence") >= PATTERN)


def trusted(edges: DataFrame, patterns: DataFrame) -> DataFrame:
    """``(instance, learned)``: the instances that patterns give a kind, of several the surest, the first of equal ones."""
    fits = reduce(lambda otherwise, k: F.when(F.col("of") == k, F.col(f"may{k}")).otherwise(otherwise), range(len(KINDS)), F.lit(False))
    evidence = dealt_join(edges.where("seed IS NULL"), patterns, "pattern", "instance", "inner").where(fits)
    trust = F.round(1 - F.exp(F.sum(F.log(1 - F.col("confidence")))), 6)
    sure = evidence.groupBy("instance", "of").agg(trust.alias("trust")).where(F.col("trust") >= INSTANCE)
    best = F.max(F.struct("trust", (-F.col("of")).alias("negative")))
    return sure.groupBy("instance").agg((-best["negative"]).alias("learned"))


def learned_kinds(edges: DataFrame) -> DataFrame:
    """``(instance, learned)`` after all rounds; each round's result is a stored table."""
    now = stored(trusted(edges, confidences(edges.withColumn("label", F.col("seed")))), "trusted")
    for _ in range(ROUNDS - 1):
        labelled = dealt_join(edges, now, "instance", "pattern", "left").withColumn("label", F.coalesce("seed", "learned"))
        now = stored(trusted(edges, confidences(labelled)), "trusted")
    return now


def free_of_rules(spans: DataFrame) -> DataFrame:
    """Rules' spans, and those others that overlap none of them."""
    forth, back = ("start", "kind", "end"), (F.desc("start"), F.desc("kind"), F.desc("end"))
    # Backwards instead of to the end, which would look at all later rows of each row again.
    before, after = (
        Window.partitionBy("uid").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1) for keys in (forth, back)
    )
    rule = lambda c: F.when(F.col("rule"), F.col(c))
    marked = spans.select(
        "*", F.max(rule("end")).over(before).alias("reached"), F.min(rule("start")).over(after).alias("next")
    )
    free = F.coalesce(F.col("reached") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("next") >= F.col("end"), F.lit(True))
    return marked.where(F.col("rule") | free).select("uid", "kind", "start", "end", "rule")


def written(spans: Column) -> Column:
    """Spans by kind and start, as text."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)`` of each row of ``docs(doc_id, text)``.

    Numbers and the digest are of the rules' spans, ``spans`` are all, as
    ``kind:start:end`` in code points, ``n_added`` those that the contexts added.
    """
    found = matched(docs)
    places = placed(found)
    edges = stored(edges_of(places), "edges")
    candidates = places.where((F.col("kind") == CANDIDATE) & (F.col("instance") != ""))
    candidates = candidates.withColumn("seed", seed_kind(F.col("instance")))
    known = dealt_join(candidates, learned_kinds(edges), "instance", "uid", "left")
    more = known.select("uid", F.coalesce("seed", "learned").alias("kind"), "start", "end", F.lit(False).alias("rule"))
    rules = places.where(F.col("kind") < CANDIDATE).select("uid", "kind", "start", "end", F.lit(True).alias("rule"))
    spans = free_of_rules(rules.unionByName(more.where("kind IS NOT NULL")))

    span = F.struct("kind", "start", "end")
    sums = spans.groupBy("uid").agg(
        *(F.count_if(F.col("rule") & (F.col("kind") == k)).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.collect_list(F.when(F.col("rule"), span)).alias("base"),
        F.collect_list(span).alias("spans"),
        F.count_if(~F.col("rule")).alias("n_added"),
    )
    empty = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    rows = found.select("uid", "doc_id").join(sums, "uid", "left")
    return rows.select(
        "doc_id",
        *(F.coalesce(f"n_{name}", F.lit(0)).cast("long").alias(f"n_{name}") for name in KINDS),
        F.sha2(written(F.coalesce("base", empty)), 256).alias("base_sha256"),
        written(F.coalesce("spans", empty)).alias("spans"),
        F.coalesce("n_added", F.lit(0)).cast("long").alias("n_added"),
    )
