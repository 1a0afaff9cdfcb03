"""Licence texts found by the digest of their canonical form.

Texts that differ only in case, punctuation, spacing, copyright statements or
equivalent spellings have one canonical form.  The digests of whole texts, and
of each line as a text of its own, are joined with the digests of known
licences and notices; there is no similarity and no search inside a line.

All of it is built-in functions and a hash join.  The known texts are a table
(``known(license_id, text)``, by default the notices below) of any size: Spark
broadcasts it when its size allows.  ``known_files`` reads a folder of full
texts as such a table.  A null text has no digest and matches
nothing; an empty text or one of copyright statements alone matches nothing either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlens.llm.store import stored

# Spellings that licence matching treats as equal, the second one canonical.
EQUIVALENT = [
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
]

# Standard notices, and short licences in full (last of their entries).
BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.\n"
)
BSD_NO_ENDORSEMENT = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n"
)
BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
KNOWN = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:\nThe above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\nTHE "
        'SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
        "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "BSD-2-Clause": [BSD_CONDITIONS + BSD_DISCLAIMER],
    "BSD-3-Clause": [BSD_CONDITIONS + BSD_NO_ENDORSEMENT + BSD_DISCLAIMER],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "CC0-1.0": ["Licensed under CC0 1.0."],
}

# Titles that a licence file may open with.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License"],
}

# A statement that opens a line: its mark and, unless there is a sign, a year, then a holder (initials count as such in
# pairs or before a last word) of some 80 letters up to the end of the sentence or line.  Prose that begins with the word
# stays, and so does what follows on the same line.
COPYRIGHT = (
    r"^[ \t]*(?:copyright[ \t]*(?:\(c\)|©)|©|\(c\)[ \t]*[0-9]{4}|copyright[ \t]+[0-9]{4})"
    r"(?: [a-z]\. [a-z]\.| [a-z]\. [^ \t\n.]+$| (?:inc|ltd|corp|co|llc)\.|\.[^ \t\n]|[^\n.]){0,80}"
    r"(?:\.|$)(?:[ \t]*all rights reserved\.?)?"
    r"|^[ \t]*all rights reserved\.?[ \t]*$"
)
NOT_WORD_IN_LINE = r"[^\p{L}\p{N}\n]+"


def spelled(text: Column) -> Column:
    """Lower case, without copyright statements, with canonical spellings; lines stay."""
    out = F.regexp_replace(F.lower(text), "(?md)" + COPYRIGHT, "")
    for variant, canonical in EQUIVALENT:
        out = F.replace(out, F.lit(variant), F.lit(canonical))
    return out


def digest(canonical: Column) -> Column:
    """SHA-256 of a canonical text, null for an empty one."""
    return F.when(canonical != "", F.sha2(canonical, 256))


def canonical_forms(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text_digest`` and, in order, the digests of the lines that have words, in place of ``text``.

    One pass turns all but words and line ends into spaces; lines and the whole
    text are both read off that.
    """
    once = rows.withColumn("text", F.regexp_replace(spelled(F.col("text").cast("string")), NOT_WORD_IN_LINE, " "))
    parts = once.withColumn("lines", F.filter(F.transform(F.split("text", "\n"), lambda line: F.trim(line)), lambda line: line != ""))
    return parts.select(
        *(c for c in rows.columns if c != "text"),
        digest(F.array_join("lines", " ")).alias("text_digest"),
        F.transform("lines", lambda line: F.sha2(line, 256)).alias("line_digests"),
    )


def known_notices(spark: SparkSession) -> DataFrame:
    """The notices and licences above, and the licences with each title that they may have."""
    rows = [(k, t) for k, ts in KNOWN.items() for t in ts]
    rows += [(k, f"{title}\n{KNOWN[k][-1]}") for k, titles in TITLES.items() for title in titles]
    return spark.createDataFrame(rows, "license_id string, text string")


def known_files(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of licence texts as a known table: one file a licence, named by its id."""
    files = spark.read.text(folder, wholetext=True)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.txt)?$", 1)
    return files.select(name.alias("license_id"), F.col("value").alias("text"))


def known_digests(known: DataFrame) -> DataFrame:
    """``(digest, license)``, one row a digest: of several licences the smallest id."""
    rows = canonical_forms(known.select(F.col("license_id").alias("license"), "text")).where("text_digest IS NOT NULL")
    return rows.groupBy(F.col("text_digest").alias("digest")).agg(F.min("license").alias("license"))


def license_scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(doc_id, text_digest, text_license, line_licenses, n_license_lines)`` of each row of ``docs(doc_id, text)``.

    ``line_licenses`` are the distinct licences of whole lines, in order, null
    if there is none.
    """
    # Stored, so that Spark knows its size and shuffles no lines if it is small.
    table = stored(known_digests(known_notices(docs.sparkSession) if known is None else known), "licenses")
    # A row's number is stored with its digests, so repeated ids and texts stay apart.
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(canonical_forms(rows), "digests")
    lines = rows.select("uid", F.explode("line_digests").alias("digest"))
    found = lines.join(table, "digest").groupBy("uid").agg(
        F.array_sort(F.collect_set("license")).alias("line_licenses"), F.count(F.lit(1)).alias("n")
    )
    whole_known = table.withColumnsRenamed({"digest": "text_digest", "license": "text_license"})
    licensed = rows.drop("line_digests").join(whole_known, "text_digest", "left").join(found, "uid", "left")
    return licensed.select(
        "doc_id",
        "text_digest",
        "text_license",
        F.array_join("line_licenses", ",").alias("line_licenses"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_license_lines"),
    )
