from peerlens.llm import license_scan as s


def scanned(spark, texts, known=None):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in s.license_scan(docs, known).collect()}


def test_forms_of_one_licence_have_one_digest(spark):
    mit = s.KNOWN["MIT"][-1]
    forms = [
        mit,
        "Copyright (c) 2020 Somebody\n\n" + mit.upper(),
        "   © 1999, 2001 A. B.\nAll rights reserved.\n" + mit.replace("\n", "\n\n").replace(",", " ,").replace('"', "“"),
        mit.replace("sublicense", "sub-licence"),
        mit.replace("free of charge", "free"),
        mit + " More.",
    ]
    got = scanned(spark, forms)
    assert [got[i].text_license for i in range(6)] == ["MIT"] * 4 + [None, None]
    assert len({got[i].text_digest for i in range(6)}) == 3


def test_lines_are_texts_of_their_own(spark):
    got = scanned(
        spark,
        ["Some prose.\nlicensed under the APACHE licence version 2.0\nReleased under the MIT License.", "Not licensed under the Apache License, Version 2.0."],
    )
    assert (got[0].line_licenses, got[0].n_license_lines, got[0].text_license) == ("Apache-2.0,MIT", 2, None)
    assert (got[1].line_licenses, got[1].n_license_lines) == (None, 0)


def test_known_tables_of_ones_own(spark):
    known = spark.createDataFrame([("b", "X y."), ("a", "x Y"), ("n", None), ("e", "...")], "license_id string, text string")
    got = scanned(spark, ["x, y!", None, "", "..."], known)
    assert [got[i].text_license for i in range(4)] == ["a", None, None, None]
    assert [got[i].text_digest is None for i in range(4)] == [False, True, True, True]
    assert scanned(spark, ["x y"], known.limit(0))[0].text_license is None


def test_edges(spark, edge_docs, no_docs):
    rows = s.license_scan(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert sum(r.text_digest is None for r in rows) == 4
    assert s.license_scan(no_docs).collect() == []
    twice = spark.createDataFrame([(1, "Released under the MIT License.")] * 2 + [(None, "Licensed under CC BY 4.0.")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.text_license, r.line_licenses, r.n_license_lines) for r in s.license_scan(twice).collect()), key=str)
    assert got == [(1, "MIT", "MIT", 1), (1, "MIT", "MIT", 1), (None, "CC-BY-4.0", "CC-BY-4.0", 1)]


def test_one_line_licences_and_prose_keep_their_text(spark):
    flat = s.KNOWN["MIT"][-1].replace("\n", " ")
    got = scanned(
        spark,
        [
            "Copyright (c) 2020 X. " + flat,
            "Copyright 2019-2021 Some Body Inc. All rights reserved. " + flat,
            "Copyright law is a branch of law that protects authors.",
            "(c) the licensee shall not sell copies",
            "Copyright (c) 2020 X. Released under the MIT License.",
            "Copyright (c) The Authors\n© 2020 A. B.\nAll rights reserved.",
        ],
    )
    assert [got[i].text_license for i in range(6)] == ["MIT", "MIT", None, None, "MIT", None]
    assert [got[i].text_digest is None for i in range(6)] == [False] * 5 + [True]
    assert got[4].line_licenses == "MIT"


def test_titles_and_wraps(spark):
    texts = []
    for licence, titles in s.TITLES.items():
        words = s.KNOWN[licence][-1].split()
        wrapped = "\n".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
        texts += [f"{title}\n\nCopyright (c) 2021, Jane Q. Doe\n\n{wrapped}" for title in ["", *titles]]
    got = scanned(spark, texts)
    want = [licence for licence, titles in s.TITLES.items() for _ in ["", *titles]]
    assert [got[i].text_license for i in range(len(texts))] == want


def test_known_files(spark, tmp_path):
    long = " ".join(f"word{i}" for i in range(5_000))
    (tmp_path / "Long-1.0.txt").write_text(f"THE LONG LICENCE\n{long}\n")
    (tmp_path / "Other").write_text("Other terms.")
    got = scanned(spark, [f"The Long License. {long}", "other terms", long], s.known_files(spark, str(tmp_path)))
    assert [got[i].text_license for i in range(3)] == ["Long-1.0", "Other", None]


def test_repeated_ids_with_different_texts(spark):
    docs = spark.createDataFrame([(1, "Licensed under CC BY 4.0."), (1, "Licensed under CC0 1.0."), (1, None)], "doc_id long, text string")
    assert sorted(str(r.text_license) for r in s.license_scan(docs).collect()) == ["CC-BY-4.0", "CC0-1.0", "None"]


def test_twin(spark, small):
    import duckdb

    from peerlens.llm.queries import ORACLES, QUERIES
    from tools.check_oracles import compare

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    df = QUERIES["op4_license_digests"](spark, small)
    result = duck.execute(ORACLES["op4_license_digests"])
    assert compare(df.columns, [tuple(r) for r in df.collect()], [c[0] for c in result.description], result.fetchall()) == "ok"
