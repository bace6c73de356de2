import zlib

import corpus_pipeline as P
from rankflow.llm import secret_scan, toxicity
from rankflow.llm.common import tokenizer_path
from tokenizers import Tokenizer

from .conftest import docs_of
from .test_exact_dedup import AZ
from .test_secret_scan import brute as secrets
from .test_simhash_dedup import brute_fingerprint, roots
from .test_tokens import check_places, pack_ids


def stage(spark, name, docs, sf_dir):
    return dict(P.STAGES)[name](spark, docs, sf_dir)


def test_run_against_brute_force(spark, small, sf_small):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    scores = toxicity.scores(small, toxicity.train(small, labels)).collect()
    toxic = {r.doc_id for r in scores if r.predicted}
    texts = {r.doc_id: r.text for r in small.collect() if r.doc_id not in toxic}
    last = {}
    for i in sorted(texts):
        last[texts[i].translate(AZ)] = i
    left = sorted(last.values())
    root = roots([brute_fingerprint(texts[i]) for i in left])
    left = [i for n, i in enumerate(left) if root[n] == n]

    rows = P.run(spark, sf_small).collect()
    assert sorted({r.doc_id for r in rows}) == left
    check_places(rows, 2048)
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    by = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == len(by.get(r.doc_id, [])) and r.length == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(pack_ids(r.ids))
        by.setdefault(r.doc_id, []).extend(r.ids)
    for i in left:
        if not secrets(texts[i]):
            ids = tokenizer.encode(texts[i], add_special_tokens=False).ids
            assert by[i] == [*ids, 0]
        else:
            assert secret_scan.MASK.lower().strip("[]") in tokenizer.decode(by[i]).replace(
                " ", "").replace("</w>", "")


def test_stages_keep_columns_and_take_odd_rows(spark, odd, none, tmp_path):
    spark.createDataFrame([(8, 1, 1), (12, 1, 0)], "doc_id long, quality int, toxic int"
                          ).write.parquet(f"{tmp_path}/labels.parquet")
    for name, _ in P.STAGES[:-1]:
        out = stage(spark, name, odd, str(tmp_path))
        assert out.schema == odd.schema and out.count() > 0
        assert stage(spark, name, none, str(tmp_path)).collect() == []
    assert stage(spark, "packing", none, str(tmp_path)).collect() == []
    assert len({r.doc_id for r in stage(spark, "packing", odd, str(tmp_path)).collect()}) == 9


def test_secret_stage_updates_n_chars_of_changed_texts_only(spark, tmp_path):
    docs = docs_of(spark, ["password=abcdefghijklmnop", "plain", None])
    rows = stage(spark, "secret_scan", docs, str(tmp_path)).orderBy("doc_id").collect()
    assert (rows[0].text, rows[0].n_chars) == ("[SECRET]", 8)
    assert [r.n_chars for r in rows[1:]] == [r.n_chars for r in docs.collect()[1:]]


def test_no_column_name_is_in_the_way(spark, tmp_path):
    """Names of helpers' columns, dotted and quoted ones, in every stage."""
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    names = ["__before", "row", "key", "a.b", "a`b", "place", "whole", "bucket", "__row", "mark", "id"]
    schema = "doc_id long, text string, n_chars long, " + ", ".join(
        f"`{n.replace('`', '``')}` string" for n in names)
    text = "a password = abcdefghijklmnop"
    docs = spark.createDataFrame(
        [(1, text, 29, *names), (2, "other text of some words", 24, *names), (None, None, None, *names)],
        schema)
    for name, _ in P.STAGES[:-1]:
        out = stage(spark, name, docs, str(tmp_path))
        assert out.columns == docs.columns
        for r in out.collect():
            assert list(r)[3:] == names
            if name == "secret_scan" and r.doc_id == 1:
                assert (r.text, r.n_chars) == ("a [SECRET]", 10)
    masked = stage(spark, "secret_scan", docs, str(tmp_path)).collect()
    assert not any("abcdefghijklmnop" in str(v) for r in masked for v in r)
    packed = stage(spark, "packing", docs, str(tmp_path)).collect()
    assert sorted(repr(r.doc_id) for r in packed) == ["1", "2", "None"]


def test_which_of_repeated_rows_stays_does_not_depend_on_order(spark):
    rows = [(7, "Same", f"src{i % 5}", i % 3) for i in range(300)] + [(8, "x", "y", 1)] * 40
    schema = "doc_id long, text string, source string, n_chars long"
    kept = set()
    for parts, order in ((1, rows), (7, rows[::-1]), (3, sorted(rows, key=str))):
        docs = spark.createDataFrame(order, schema).repartition(parts)
        out = P.drop_copies(spark, docs, "")
        assert out.schema == docs.schema
        kept.add(tuple(sorted(tuple(r) for r in out.collect())))
    assert len(kept) == 1 and len(kept.pop()) == 2


def test_without_the_subpackage_the_entry_still_imports(tmp_path):
    """What is left when this part is deleted."""
    import shutil
    import subprocess
    import sys

    from rankflow.llm.common import ROOT

    shutil.copytree(f"{ROOT}/rankflow", tmp_path / "rankflow",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; "
         "print(len(e.queries()), any(k.startswith('op') for k in e.queries()))"],
        cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert said.stdout.split()[1:] == ["False"], said.stderr
