"""Reads that go on without what is broken, and results kept until a commit."""

import json
import shutil

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankflow.operators.seasons import json_type_report, require_schema, schema_differences
from rankflow.plans.besteffort import (
    SkippedSeasons, best_effort_poll_table, best_effort_snapshots, season_list,
)
from rankflow.plans.cleansed import poll_table, read_cleansed, write_cleansed
from rankflow.plans.memo import forget, memoised, memoised_poll_table
from rankflow.plans.queries import _cleansed
from rankflow.schemas import CLEANSED
from rankflow.sources.readers import SkippedDocuments, land_raw, unwrap_envelope, warn_skipped
from rankflow.sources.snapshots import available_seasons, list_files

SF = "/root/testdata/sf0.001"
OLD, NEW = "2024-01-01T00-00-00Z", "2024-02-01T00-00-00Z"


@pytest.fixture(scope="module")
def rows(spark):
    return _cleansed(spark, SF).cache()


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def files_of(store, season):
    return sorted((store / f"season={season}").rglob("part-*"))


@pytest.mark.parametrize("fmt", ["parquet", "columnar-json"])
def test_broken_seasons_cost_themselves_only(spark, rows, tmp_path, fmt):
    store = tmp_path / "store"
    write_cleansed(rows, str(store), NEW, fmt)
    seasons = sorted(r.season for r in rows.select("season").distinct().collect() if r.season)
    torn, gone, cut = seasons[:3]
    for f in files_of(store, torn):
        f.write_text('{"columns": [{"name": "school", "val')
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    shutil.rmtree(store / f"season={gone}")
    files_of(store, cut)[0].unlink()
    with pytest.warns(SkippedSeasons, match=f"season {gone}: folder is missing"):
        got = best_effort_poll_table(spark, str(store), "1-URGENT", "regular",
                                     seasons=[*seasons, 1900])
    skipped = {r.season: (r.snapshot, r.reason) for r in got.skipped.collect()}
    assert skipped.keys() == {torn, gone, cut, 1900}
    assert skipped[gone] == (NEW, "folder is missing")
    assert skipped[1900] == (None, "no snapshot")
    assert skipped[torn][1].startswith("0 of ") and "rows are readable" in skipped[cut][1]
    want = rows.where(F.col("season").isin(seasons[3:])
                      & (F.col("poll") == "1-URGENT") & (F.col("seasonType") == "regular"))
    assert want.count() > 0
    assert same(got.rows.drop("snapshot").select(*rows.columns), want)
    with pytest.raises(Exception):
        poll_table(spark, str(store), "1-URGENT", "regular").collect()


def test_damage_inside_a_file_and_rows_that_nobody_committed(spark, rows, tmp_path):
    store = tmp_path / "store"
    write_cleansed(rows, str(store), NEW)
    seasons = sorted(r.season for r in rows.select("season").distinct().collect() if r.season)
    one = files_of(store, seasons[0])[0]
    raw = bytearray(one.read_bytes())
    raw[4:200] = b"\0" * 196  # pages of the first columns; the footer is whole
    one.write_bytes(raw)
    one.with_name(f".{one.name}.crc").unlink(missing_ok=True)
    twice = files_of(store, seasons[1])[0]
    shutil.copy(twice, twice.with_name("part-copied.parquet"))
    stray = files_of(store, seasons[2])[0].with_name("part-stray.parquet")
    stray.write_text("not Parquet, and no row is missing")
    with pytest.warns(SkippedSeasons):
        chosen, skipped = best_effort_snapshots(spark, str(store))
    assert {r.season for r in skipped.collect()} == set(seasons[:2])
    served = read_cleansed(spark, str(store), chosen, ignore_strays=True)
    want = rows.where(~F.coalesce(F.col("season").isin(seasons[:2]), F.lit(False)))
    assert same(served.drop("snapshot").select(*rows.columns), want)


def test_a_sound_store_skips_nothing(spark, rows, tmp_path, recwarn):
    store = str(tmp_path / "store")
    write_cleansed(rows, store, NEW)
    got = best_effort_poll_table(spark, store, "1-URGENT", "regular")
    assert got.skipped.collect() == []
    assert same(got.rows, poll_table(spark, store, "1-URGENT", "regular"))
    assert not [w for w in recwarn if issubclass(w.category, SkippedSeasons)]
    empty = best_effort_poll_table(spark, str(tmp_path / "none"), "1-URGENT", "regular")
    assert empty.rows.collect() == [] and empty.skipped.collect() == []


def test_raw_snapshots_are_probed_as_well(spark, tmp_path):
    for season in (2023, 2024):
        land_raw(spark.createDataFrame([("{}",), ("{}",)], "v string"), str(tmp_path), "rankings",
                 season, NEW)
    shutil.rmtree(tmp_path / "rankings" / "season=2023")
    with pytest.warns(SkippedSeasons):
        chosen, skipped = best_effort_snapshots(spark, str(tmp_path), "rankings")
    assert [r.season for r in chosen] == [2024] and [r.season for r in skipped.collect()] == [2023]


# -- envelopes -------------------------------------------------------------------

ROW = T.StructType([T.StructField("school", T.StringType()), T.StructField("rank", T.IntegerType())])
DOCS = [
    ('{"season": 2024, "data": [{"school": "A", "rank": 1}, {"school": "B"}]}', "envelope"),
    ('{"season": 2024, "data": []}', "envelope"),
    ('[{"school": "C"}]', "rows"), ("[]", "rows"),
    ('{"season": 0, "data": [{"school": "X"}]}', "odd"), ('{"data": [{"school": "X"}]}', "odd"),
    ('{"season": 2024}', "odd"), ("not JSON", "odd"), ("", "odd"), (None, "odd"), ("17", "odd"),
]


def test_shapes_are_counted_in_the_pass_that_reads(spark):
    docs = spark.createDataFrame([(d,) for d, _ in DOCS], "doc string").repartition(3)
    seen = Observation("shapes")
    got = unwrap_envelope(docs, ROW, seen=seen).collect()
    assert sorted(r.school for r in got) == ["A", "B", "C"]
    with pytest.warns(SkippedDocuments, match="7 of 11 documents"):
        counts = warn_skipped(seen)
    assert counts == {"documents": 11, "envelope": 2, "rows": 2, "odd": 7, "data_rows": 3}
    assert sorted(r.school for r in unwrap_envelope(docs, ROW).collect()) == ["A", "B", "C"]


def test_no_warning_when_nothing_is_left_out(spark, recwarn):
    seen = Observation("none")
    docs = spark.createDataFrame([("[]",)], "doc string")
    assert unwrap_envelope(docs, ROW, seen=seen).collect() == []
    assert warn_skipped(seen)["odd"] == 0
    assert not [w for w in recwarn if issubclass(w.category, SkippedDocuments)]
    none = Observation("empty")
    assert unwrap_envelope(docs.limit(0), ROW, seen=none).collect() == []
    assert warn_skipped(none)["data_rows"] == 0


# -- season list, schemas ----------------------------------------------------------

def test_default_seasons_on_failure_only(spark, tmp_path, recwarn):
    def listed(path):
        return lambda: available_seasons(list_files(spark, str(path)))

    folder = tmp_path / "cleansed" / "2023"
    folder.mkdir(parents=True)
    (folder / "poll_x.json").write_text("[]")
    assert [r.season for r in season_list(spark, listed(tmp_path)).collect()] == [2023]
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "other.json").write_text("[]")
    assert season_list(spark, listed(empty)).collect() == []
    assert not [w for w in recwarn if issubclass(w.category, SkippedSeasons)]
    with pytest.warns(SkippedSeasons, match="no season list"):
        got = season_list(spark, listed(tmp_path / "none"), default=[2022, 2024]).collect()
    assert [r.season for r in got] == [2024, 2022]
    with pytest.raises(ZeroDivisionError):  # a mistake in the caller's code is no failed listing
        season_list(spark, lambda: 1 / 0)


def test_typed_schema_check(spark, rows):
    assert require_schema(rows, CLEANSED) is rows
    more = rows.withColumn("extra", F.lit(1))
    assert require_schema(more, CLEANSED) is more
    with pytest.raises(TypeError, match="extra is int, not declared"):
        require_schema(more, CLEANSED, extra=False)
    bad = rows.withColumn("rank", F.col("rank").cast("string")).drop("logos")
    with pytest.raises(TypeError, match="rank is string, not int; logos is missing"):
        require_schema(bad, CLEANSED)
    assert schema_differences(bad.schema, CLEANSED) == [
        ("rank", "int", "string"), ("logos", "array<string>", None)]


def test_json_types_of_documents(spark):
    schema = T.StructType([*ROW.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("logos", T.ArrayType(T.StringType()))])
    docs = ['[{"school": "A", "rank": 1, "score": 1.5, "logos": []}, {"school": null}]',
            '[{"school": 7, "rank": "1", "score": 2, "logos": "x", "new": true}, 5]',
            '{"school": "A"}', "broken", None, "[]", '[{"rank": 1.5}]']
    got = json_type_report(spark.createDataFrame([(d,) for d in docs], "doc string"), schema)
    assert {(r.column, r.expected, r.found): r.n for r in got.collect()} == {
        ("school", "STRING", "BIGINT"): 1, ("rank", "BIGINT", "STRING"): 1,
        ("rank", "BIGINT", "DECIMAL"): 1, ("logos", "ARRAY", "STRING"): 1,
        ("new", None, "BOOLEAN"): 1, (None, "OBJECT", "BIGINT"): 1,
        (None, "ARRAY", "OBJECT"): 1, (None, "ARRAY", "no JSON"): 2}


# -- kept results --------------------------------------------------------------------

def test_kept_until_the_next_commit(spark, rows, tmp_path):
    store = str(tmp_path / "store")
    write_cleansed(rows, store, OLD)
    first = memoised_poll_table(spark, store, "1-URGENT", "regular")
    again = memoised_poll_table(spark, store, "1-URGENT", "regular")
    assert same(first, poll_table(spark, store, "1-URGENT", "regular"))
    # the second call scans the result and no facts
    assert again.inputFiles() and all("/_results/" in f for f in again.inputFiles())
    assert set(again.inputFiles()) == set(first.inputFiles())
    other = memoised_poll_table(spark, store, "2-HIGH", "regular")
    assert {r.poll for r in other.select("poll").distinct().collect()} == {"2-HIGH"}

    write_cleansed(rows.withColumn("points", F.col("points") + 1000), store, NEW)
    fresh = memoised_poll_table(spark, store, "1-URGENT", "regular")
    assert fresh.where("points > 1000").count() == fresh.count() == first.count()
    assert same(again, first)  # what was read before stays readable
    key = {"poll": "1-URGENT", "season_type": "regular", "seasons": None}
    assert forget(spark, store, "poll_table", **key) == 1
    assert forget(spark, store, "poll_table", **key) == 0
    assert memoised_poll_table(spark, store, "1-URGENT", "regular").count() == fresh.count()


def test_a_commit_during_the_computation_is_not_passed_off_as_older(spark, rows, tmp_path):
    store = str(tmp_path / "store")
    write_cleansed(rows, store, OLD)

    def build(version):
        write_cleansed(rows.limit(0), store, NEW, seasons=rows.select("season").distinct())
        return poll_table(spark, store, "1-URGENT", "regular", None, version)

    assert memoised(spark, store, "slow", build).count() > 0  # as of its own version
    assert memoised_poll_table(spark, store, "1-URGENT", "regular").count() == 0


def test_an_empty_result_is_a_result(spark, tmp_path):
    calls = []

    def build(version):
        calls.append(version)
        return spark.createDataFrame([], "a int, b string")

    for _ in range(2):
        got = memoised(spark, str(tmp_path), "nothing", build)
        assert got.columns == ["a", "b"] and got.collect() == []
    assert calls == [-1]


def test_documents_of_the_same_text_are_counted_each(spark):
    docs = spark.createDataFrame([(json.dumps([{"school": "A"}]),)] * 50, "doc string")
    seen = Observation("copies")
    assert unwrap_envelope(docs.repartition(4), ROW, seen=seen).count() == 50
    assert seen.get["rows"] == 50
