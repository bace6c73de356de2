from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from rankflow.llm import fim
from rankflow.llm.queries import op12_fill_in_middle

from .conftest import LONG, ODD_IDS, ODD_TEXTS, docs_of


def brute(doc_id, text):
    text = text or ""
    n = len(text)
    hexed = sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h = [int(hexed[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = h[0] % (n + 1), h[1] % (n + 1)
    a, b = min(a, b), max(a, b)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if text == "" or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return "plain", None, None, text
    if h[3] % 100 < 20:
        return "spm", a, b - a, "<S>" + suffix + "<P>" + prefix + "<M>" + middle
    return "psm", a, b - a, "<P>" + prefix + "<S>" + suffix + "<M>" + middle


def sha(text):
    return sha256(text.encode()).hexdigest()


def expected(ids, texts):
    out = []
    for i, t in zip(ids, texts, strict=True):
        form, prefix, middle, output = brute(i, t)
        out.append((i, len(t or ""), form, prefix, middle, sha(output), sha(t or "")))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


MARKED = ["a <P> b", "<S>", "x<M", "<P", "<<S>>", "<", "ends with <", "<M>" * 3000, "a<P<S<M"]


@pytest.mark.parametrize("chunk", [1, 7, fim.CHUNK])
def test_odd_rows_against_brute_force(spark, odd, chunk):
    assert rows(fim.digests(odd, chunk=chunk)) == expected(ODD_IDS, ODD_TEXTS)


def test_marks_at_the_edges_of_pieces(spark):
    ids = list(range(40, 40 + 20 * len(MARKED)))
    texts = MARKED * 20
    found = fim.digests(docs_of(spark, texts, ids), chunk=2)
    assert rows(found) == expected(ids, texts)
    assert {r[2] for r in rows(found)} == {"plain", "psm", "spm"}


def test_outputs_and_their_restoration(spark, odd):
    out = fim.outputs(odd, chunk=100).withColumn("back", fim.restored())
    want = sorted(((i, brute(i, t)[0], brute(i, t)[3], t or "")
                   for i, t in zip(ODD_IDS, ODD_TEXTS, strict=True)), key=repr)
    assert rows(out.select("doc_id", "form", "output", "back")) == want


def test_one_doc_id_on_a_third_of_all_rows(spark):
    ids = [7 if i % 3 == 0 else i for i in range(300)]
    texts = [f"text number {i} " * (i % 9) for i in range(300)]
    docs = docs_of(spark, texts, ids).repartition(4)
    assert rows(fim.digests(docs, chunk=8)) == expected(ids, texts)
    # rows, not doc_ids, are dealt: the hot one is in every partition
    spread = fim.in_output_order(fim.pieces(docs, 8), 4)
    where = spread.filter("doc_id = 7").select(F.spark_partition_id().alias("p")).distinct()
    assert where.count() == 4


def test_parser_gives_parts_whatever_the_pieces():
    text = "one < two <P three >"
    for form, (a, b) in (("psm", (3, 9)), ("spm", (0, 20)), ("psm", (12, 12))):
        whole = "".join(m + text[s:e] for m, s, e in fim.parts_of(text, form, a, b))
        for size in range(1, len(whole) + 1):
            parser, got = fim.Parser(form), {0: "", 1: "", 2: ""}
            for at in range(0, len(whole), size):
                for part, found in parser.feed(whole[at:at + size]):
                    got[part] += found
            for part, found in parser.end():
                got[part] += found
            assert (got[0], got[1], got[2]) == (text[:a], text[a:b], text[b:])


def test_empty_table(none):
    assert fim.digests(none).collect() == []
    assert fim.outputs(none).collect() == []


def test_one_shuffle_of_the_texts(odd):
    plan = fim.digests(odd)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(row") == 1


def test_query_over_the_whole_table(spark, sf_small, small):
    found = rows(op12_fill_in_middle(spark, sf_small))
    docs = small.select("doc_id", "text").collect()
    assert found == expected([d.doc_id for d in docs], [d.text for d in docs])
    assert LONG  # a text of many pieces is among the odd ones
