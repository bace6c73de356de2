import textwrap

from rankflow.llm import license_scan as S

from .conftest import ODD_IDS, docs_of


def test_forms_of_one_text_are_equal(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0.",
        "  LICENCED under the apache licence -- version 2 0",
        "Copyright (c) 2020 Someone\n(c) Another\nlicensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.1.",
        "Copyright 2024 Me. All rights reserved.\n\n" + S._MIT.replace("\n", " ").lower(),
        "words\nReleased under the MIT License.\nReleased under the MIT licence!\n"
        "Licensed under CC BY-NC 4.0.",
        "the licence of a licence licence", "",
    ]
    rows = S.scan(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r.license for r in rows] == ["Apache-2.0"] * 3 + [None, "MIT"] + [None] * 3
    assert len({r.canonical_sha256 for r in rows[:3]}) == 1
    assert (rows[5].notices, rows[5].n_notices) == ("CC-BY-NC-4.0,MIT", 3)
    assert rows[3].notices == "" and rows[7].n_notices == 0


def test_the_sql_has_the_same_rule(spark, small, odd):
    """Query and oracle on statements of all kinds, and on the documents."""
    import duckdb

    texts = [r.text for r in small.select("text").collect()] + [
        "Copyright (c) 2024 X. Licensed under the MIT License.", "(c) (C) \u00a9 2019 Y, Inc. Words",
        "Copyright J. Doe\nAll rights reserved\nText", "all rights reserved. more", "(c) You must",
        "the copyright notice\n  copyright notice and this\nCopyright Acme", "copyrighted works",
        "Line\n* Copyright 2020 A\n* Copyright 2021 B\n\nText\n \n\nMore", None, "",
        *[a + S._MIT + b for a in ("", "Intro.\n\n") for b in ("", "\n\nOutro.")]]
    docs = docs_of(spark, texts)
    got = sorted(tuple(r) for r in S.scan(docs).collect())
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    assert got == sorted(con.execute(S.oracle_sql()).fetchall())


def test_whole_licences_inside_longer_documents(spark):
    whole = dict(S.texts_of(S.TEXTS)) | {"MIT": S._MIT, "ISC": S._ISC}
    gpl, apache = whole["GPL-3.0"], whole["Apache-2.0"]
    texts = [f"A program.\n\nCopyright (c) 2021 Someone\n\n{t}\n\nThe end." for t in whole.values()]
    texts += [t for t in whole.values()]
    texts += [f"{apache}\n\n{gpl}", apache.replace("\n\n", "\n \t\n\n"),
              "\n\n".join(gpl.split("\n\n")[:-1]), "\n\n".join(reversed(gpl.split("\n\n")))]
    rows = S.scan(docs_of(spark, texts)).orderBy("doc_id").collect()
    n = len(whole)
    for name, inside, alone in zip(whole, rows, rows[n:], strict=False):
        assert name in inside.embedded.split(",") and inside.license is None, name
        assert alone.license == name and name in alone.embedded.split(",")
    assert rows[2 * n].embedded == "Apache-2.0,GPL-3.0"
    assert rows[2 * n + 1].embedded == "Apache-2.0"
    assert [r.embedded for r in rows[2 * n + 2:]] == ["", ""]


def test_long_adversarial_texts_take_time_in_proportion(spark):
    import time

    n = 1_000_000
    texts = [x * (n // len(x)) for x in (
        "copyright ", "\u00a9", "(c) ", "(", " ", "\n", "copyright\n", "c. ", "all rights reserved ",
        "copyright 2020 a ", "copyright (", " \n", "licensed under ", "copyright notice ")]
    texts.append("Copyright 2020 a" + " " * n + "b")
    docs = docs_of(spark, texts).repartition(4).cache()
    docs.count()
    began = time.time()
    rows = S.scan(docs).collect()
    assert len(rows) == len(texts) and time.time() - began < 120
    docs.unpersist()


def test_own_texts(spark):
    known = [("own", "Mine, all mine."), ("a-own", "mine all MINE")]
    rows = S.scan(docs_of(spark, ["mine; all mine", "Released under the MIT License."]), known)
    assert [r.license for r in rows.orderBy("doc_id").collect()] == ["a-own", None]


def test_odd_rows_and_empty_table(odd, none):
    rows = S.scan(odd).collect()
    assert sorted(repr(r.doc_id) for r in rows) == sorted(map(repr, ODD_IDS))
    assert all(len(r.canonical_sha256) == 64 and r.license is None for r in rows)
    assert S.scan(none).collect() == []


def test_notices_under_any_wrapping(spark):
    """Texts that name no holder themselves. (Where a licence's own text has a
    copyright line, as GPL's has, its end shows by the line's.)"""
    holders = ["", "Copyright (c) 2024 X. ", "Copyright (c) 2019-2021 Jane Q. Doe, Acme Inc.\n\n",
               "Copyright 2020 Someone\nAll rights reserved.\n\n", "\u00a9 2021 Me "]
    texts, want = [], []
    for name, text in S.NOTICES:
        words = " ".join(text.split())
        forms = [words, *(textwrap.fill(words, n) for n in (20, 41, 60, 72, 100)),
                 words.replace(" ", "\n")]
        forms += [h + form for h in holders for form in forms[:4]]
        texts += forms
        want += [name] * len(forms)
    texts += ["copyright notice and this permission notice appear in all copies.", "(c) You must"]
    rows = S.scan(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r.license for r in rows] == [*want, None, None]
    assert len({r.canonical_sha256 for r in rows[-2:]}
               | {r.canonical_sha256 for r in S.scan(docs_of(spark, [""])).collect()}) == 3
