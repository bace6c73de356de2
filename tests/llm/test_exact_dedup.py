from collections import defaultdict
from hashlib import sha256

from rankflow.llm.exact_dedup import exact_duplicates, keep_distinct

from .conftest import ODD_IDS, ODD_TEXTS, docs_of

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(ids, texts):
    groups = defaultdict(list)
    for i, t in zip(ids, texts, strict=True):
        groups[(t or "").translate(AZ)].append(i)
    out = []
    for t, members in groups.items():
        known = [i for i in members if i is not None]
        keep = max(known) if known else None
        left = 1
        for i in members:
            kept = i == keep and left > 0
            left -= kept
            out.append((i, keep, len(members), kept, sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_rows_against_brute_force(odd):
    assert rows(exact_duplicates(odd)) == brute(ODD_IDS, ODD_TEXTS)


def test_hot_group_and_salts(spark):
    ids = list(range(600))
    texts = ["Copy" if i % 3 == 0 else f"text {i // 2}" for i in ids]
    found = exact_duplicates(docs_of(spark, texts, ids).repartition(4), salts=7, block=8,
                             hot_share=10)
    assert rows(found) == brute(ids, texts)


def test_only_a_to_z_are_folded(spark):
    found = exact_duplicates(docs_of(spark, ["É", "é", "E", "e"])).collect()
    assert sorted(r.group_size for r in found) == [1, 1, 2, 2]


def test_empty_table(none):
    assert exact_duplicates(none).collect() == []
    assert keep_distinct(none).columns == none.columns


def test_keep_distinct_keeps_columns_and_one_row_a_text(odd):
    kept = keep_distinct(odd)
    assert kept.schema == odd.schema
    texts = sorted((r.text or "").translate(AZ) for r in kept.collect())
    assert texts == sorted({(t or "").translate(AZ) for t in ODD_TEXTS})


def test_one_doc_id_and_text_on_a_third_of_all_rows(spark):
    """Repeated rows, hot ones: one is kept, by an aggregate and not by a window."""
    ids = [7 if i % 3 == 0 else None if i % 3 == 1 else i for i in range(600)]
    texts = ["Same" if i % 3 < 2 else f"text {i}" for i in range(600)]
    found = exact_duplicates(docs_of(spark, texts, ids).repartition(4), hot_share=10)
    assert rows(found) == brute(ids, texts)
    assert sum(r.kept for r in found.collect()) == len(set(texts))
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
