"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

NGRAM_GROUPS = r"""
WITH RECURSIVE
words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS i FROM words)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c >= 75 * (x.n + y.n - c)
),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles,
    least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id,
    (SELECT count(*) FROM links WHERE a = doc_id) AS n_links
FROM documents LEFT JOIN sizes USING (doc_id)
"""

MIX = r"""
WITH RECURSIVE
sized AS (
    SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        -ln((('0x' || md5(coalesce(doc_id::VARCHAR, ''))[:13])::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
        / (1.0::DOUBLE / (1.0::DOUBLE + coalesce(10.0::DOUBLE * (length(text) - length(translate(text,
            '*#$%&!|{}<>=@~^_', ''))) / nullif(length(text), 0), 0.0::DOUBLE))) AS key
    FROM documents
),
sources AS (
    SELECT source, sum(size)::DOUBLE AS total, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM sized GROUP BY source
),
weighed AS (
    SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][place % 3 + 1] AS weight, sum(total) OVER () * 1.5 AS words
    FROM sources
),
-- The excess is reshared round by round; a target that reaches its cap stays there.
rounds AS (
    SELECT source, total, weight, words, false AS capped, 0 AS round FROM weighed
    UNION ALL
    SELECT source, total, weight, words, capped OR weight * (words - sum(CASE WHEN capped THEN 2 * total ELSE 0 END) OVER ())
        / sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () > 2 * total, round + 1
    FROM rounds WHERE round < 60
),
targets AS (
    SELECT source, total, CASE WHEN capped THEN 2 * total ELSE weight * (words - sum(CASE WHEN capped THEN 2 * total
        ELSE 0 END) OVER ()) / sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () END AS target
    FROM rounds WHERE round = 60
),
placed AS (
    SELECT s.*, total, target, CASE WHEN total > 0 THEN floor(target / total) ELSE 0 END AS epochs,
        sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size AS before
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
chosen AS (
    SELECT *, epochs + CASE WHEN target - epochs * total > 0 AND 2 * before + size <= 2 * (target - epochs * total)
        THEN 1 ELSE 0 END AS copies
    FROM placed
)
SELECT doc_id, size::BIGINT AS size, total::BIGINT AS source_size, target, copies::BIGINT AS copies,
    (copies * size)::BIGINT AS taken
FROM chosen
"""

TOP_K = """
WITH whole AS (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.row, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON c.row <> q.row AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


def _license_scan() -> str:
    # A statement that opens a line, up to the end of the sentence or line.
    statement = (
        r"^[ \t]*(?:copyright[ \t]*(?:\(c\)|©)|©|\(c\)[ \t]*[0-9]{4}|copyright[ \t]+[0-9]{4})"
        r"(?: [a-z]\. [a-z]\.| [a-z]\. [^ \t\n.]+$| (?:inc|ltd|corp|co|llc)\.|\.[^ \t\n]|[^\n.]){0,80}"
        r"(?:\.|$)(?:[ \t]*all rights reserved\.?)?"
        r"|^[ \t]*all rights reserved\.?[ \t]*$"
    )
    spelled = f"regexp_replace(lower(text), '(?m){statement}', '', 'g')"
    # The spellings treated as equal.
    for variant, canonical in (
        ("licence", "license"),
        ("sub-license", "sublicense"),
        ("sub license", "sublicense"),
        ("non-commercial", "noncommercial"),
        ("non commercial", "noncommercial"),
        ("acknowledgement", "acknowledgment"),
        ("merchantibility", "merchantability"),
        ("per cent", "percent"),
        ("favour", "favor"),
        ("honour", "honor"),
        ("organisation", "organization"),
        ("redistribution and use in source or", "redistribution and use in source and"),
    ):
        spelled = f"replace({spelled}, '{variant}', '{canonical}')"
    words = r"trim(regexp_replace({}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    # The notices that occur as lines; none of the full texts does.
    notices = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
        "Licensed under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Licensed under CC BY 4.0.": "CC-BY-4.0",
        "Licensed under CC0 1.0.": "CC0-1.0",
    }
    values = ", ".join(f"('{t}', '{k}')" for t, k in notices.items())
    return f"""
WITH known AS (
    SELECT {words.format("lower(t)")} AS canonical, license FROM (VALUES {values}) v(t, license)
),
spelled AS (SELECT doc_id, {spelled} AS text FROM documents),
whole AS (SELECT doc_id, text, {words.format("text")} AS canonical FROM spelled),
lines AS (
    SELECT doc_id, {words.format("line")} AS canonical
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM spelled)
),
found AS (
    SELECT doc_id, array_to_string(list_sort(list_distinct(list(license))), ',') AS names, count(*) AS n
    FROM lines JOIN known USING (canonical) GROUP BY doc_id
)
SELECT whole.doc_id, CASE WHEN whole.canonical <> '' THEN sha256(whole.canonical) END AS text_digest,
    known.license AS text_license, names AS line_licenses, coalesce(n, 0) AS n_license_lines
FROM whole LEFT JOIN known ON known.canonical = whole.canonical LEFT JOIN found ON found.doc_id = whole.doc_id
"""


LICENSE_SCAN = _license_scan()

# CRC-32 is linear: the CRC of a text is the XOR of what each byte gives at its distance from the end.
IMPORTANCE = r"""
WITH RECURSIVE
bytes AS (
    SELECT b, b AS v, 0 AS k FROM (SELECT unnest(range(256)) AS b)
    UNION ALL
    SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bytes WHERE k < 8
),
one AS (SELECT b, v FROM bytes WHERE k = 8),
words AS (
    SELECT 'c' AS kind, doc_id, row_number() OVER () AS id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
    UNION ALL
    SELECT 't', NULL, row_number() OVER (), regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
    FROM benchmark
),
placed AS (SELECT kind, id, w, unnest(range(1, len(w) + 1)) AS i FROM words),
features AS (
    SELECT kind, id, f, count(*) AS n FROM (
        SELECT kind, id, w[i] AS f FROM placed
        UNION ALL
        SELECT kind, id, w[i] || ' ' || w[i + 1] FROM placed WHERE i < len(w)
    ) GROUP BY ALL
),
names AS (SELECT DISTINCT f FROM features),
longest AS (SELECT max(strlen(f)) AS bytes FROM names),
far AS (
    SELECT 0 AS d, b, v FROM one
    UNION ALL
    SELECT d + 1, far.b, xor(far.v >> 8, one.v) FROM far JOIN one ON one.b = far.v & 255 WHERE d < (SELECT bytes FROM longest)
),
zeros AS (
    SELECT 0 AS d, 4294967295 AS v
    UNION ALL
    SELECT d + 1, xor(zeros.v >> 8, one.v) FROM zeros JOIN one ON one.b = zeros.v & 255 WHERE d < (SELECT bytes FROM longest)
),
spelled AS (
    SELECT f, strlen(f) AS bytes, ('0x' || substr(hex(f), 2 * i + 1, 2))::INT AS b, strlen(f) - 1 - i AS d
    FROM (SELECT f, unnest(range(strlen(f))) AS i FROM names)
),
hashed AS (
    SELECT f, xor(xor(bit_xor(far.v), any_value(zeros.v)), 4294967295) % 10000 AS bucket
    FROM spelled JOIN far ON far.d = spelled.d AND far.b = spelled.b JOIN zeros ON zeros.d = spelled.bytes
    GROUP BY f
),
totals AS (
    SELECT bucket, coalesce(sum(n) FILTER (kind = 'c'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 't'), 0)::DOUBLE AS t
    FROM features JOIN hashed USING (f) GROUP BY bucket
),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM totals) + 10000)
        / ((s + 1) * ((SELECT sum(t) FROM totals) + 10000)))) AS gain
    FROM totals
),
weights AS (
    SELECT id, sum(n) AS n_features, floor(sum(n * gain) / sum(n)) AS weight
    FROM features JOIN hashed USING (f) JOIN gains USING (bucket) WHERE kind = 'c' GROUP BY id
),
scored AS (
    SELECT doc_id, id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[:8])::BIGINT
        + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
    FROM words LEFT JOIN weights USING (id) WHERE kind = 'c'
),
ranked AS (
    SELECT id, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () * 25 // 100 AS drawn
    FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank, n_words
FROM scored LEFT JOIN ranked USING (id)
"""
