import gzip

import pytest
from conftest import rows
from fixture_tables import COLUMNS, N, ROWS

from marquee.operators.shaping import normalise
from marquee.schemas import TABLES
from marquee.sources import catalogue, formats, ingest, rejects
from marquee.sources.scratch import scratch_folder


def test_every_table_loads(spark, bases):
    loaded = catalogue.Catalogue(spark, bases.parquet)
    frames = {
        "titles": loaded.titles(),
        "ratings": loaded.ratings(),
        "names": loaded.names(),
        "akas": loaded.akas(),
        "episodes": loaded.episodes(),
        "principals": loaded.principals(),
        "crew": loaded.crew(),
    }
    for name, frame in frames.items():
        assert frame.columns == COLUMNS[name].split()
        assert frame.count() == len(ROWS[name])


def test_text_is_typed_and_unmarked(small):
    assert dict(small.titles.dtypes)["startYear"] == "int"
    assert dict(small.ratings.dtypes) == {"tconst": "string", "averageRating": "double", "numVotes": "int"}
    got = {r.tconst: r for r in small.titles.collect()}
    assert got["t6"].startYear is None and got["t6"].runtimeMinutes is None
    assert got["t7"].runtimeMinutes is None and got["t7"].genres is None
    assert got["t7"].primaryTitle == 'Eta, "Two"'
    assert got["t1"].isAdult == 0


def test_marked_parquet_equals_ingested(spark, small, tmp_path):
    marked = spark.createDataFrame(ROWS["titles"], COLUMNS["titles"].split())
    path = str(tmp_path / TABLES["titles"].parquet_dir)
    marked.write.parquet(path)
    typed = catalogue.Catalogue(spark, str(tmp_path)).titles()
    assert sorted(rows(typed), key=str) == sorted(rows(small.titles), key=str)
    assert sorted(rows(normalise(typed, "titles")), key=str) == sorted(rows(typed), key=str)


def test_bad_numbers_become_null(spark):
    raw = spark.createDataFrame(
        [("t1", "movie", "abcd"), ("t2", N, "1999"), ("t3", "movie", None)], ["tconst", "titleType", "startYear"]
    )
    assert rows(normalise(raw, "titles")) == [("t1", "movie", None), ("t2", None, 1999), ("t3", "movie", None)]


def test_one_part_file_and_default_format(spark, bases):
    path = catalogue.join_path(bases.parquet, TABLES["ratings"].parquet_dir)
    part = spark.read.parquet(path).inputFiles()[0]
    assert catalogue.read_columnar(spark, part).count() > 0
    assert spark.read.load(path).count() == len(ROWS["ratings"])


def test_filters_reach_the_scan_of_ingested_tables(spark, bases):
    titles = catalogue.Catalogue(spark, bases.parquet, ingested=True).titles()
    plan = titles.where("isAdult = 0 AND titleType = 'movie'").select("tconst")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(isAdult,0)" in text and "EqualTo(titleType,movie)" in text
    assert "primaryTitle" not in text


def test_comma_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n3,4\n")
    frame = catalogue.read_comma_text(spark, str(tmp_path / "a.csv"))
    assert frame.columns == ["a", "b"] and frame.count() == 2


def test_csv_sink_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    for last in (3, 5):
        ingest.write_csv(spark.range(last).selectExpr("id", "id * 0.5 AS half"), path)
    back = catalogue.read_comma_text(spark, path)
    assert back.columns == ["id", "half"] and back.count() == 5


def test_text_round_trip(spark, small, tmp_path):
    path = str(tmp_path / "titles")
    ingest.write_text(small.titles, path)
    back = catalogue.read_text(spark, path, "titles")
    assert sorted(rows(back), key=str) == sorted(rows(small.titles), key=str)


def test_table_schemas(spark, small):
    got = catalogue.table_schemas(
        {"ratings": small.ratings, "crew": small.crew}, rows=2, order_by={"ratings": ["tconst"]}
    )
    listed = sorted(rows(got.select("table_name", "position", "column_name", "data_type").distinct()))
    assert listed == [
        ("crew", 0, "tconst", "string"),
        ("crew", 1, "directors", "string"),
        ("crew", 2, "writers", "string"),
        ("ratings", 0, "tconst", "string"),
        ("ratings", 1, "averageRating", "double"),
        ("ratings", 2, "numVotes", "int"),
    ]
    keys = rows(got.where("table_name = 'ratings' AND position = 0").select("value").orderBy("value"))
    assert keys == [("t1",), ("t2",)]


def test_format_comparison_skips_missing(spark, bases, tmp_path):
    got = formats.compare_formats(spark, bases.text, bases.parquet, ["ratings", "crew"])
    assert [(r.dataset, r.tsv_count, r.parquet_count) for r in got.collect()] == [
        ("title.ratings", 7, 7),
        ("title.crew", 5, 5),
    ]
    for row in got.collect():
        assert row.compression_ratio == pytest.approx((row.tsv_size - row.parquet_size) / row.tsv_size * 100)
    summary = formats.format_summary(got).first()
    assert summary.smallest in ("title.ratings", "title.crew")
    assert summary.best_compression_ratio >= summary.avg_compression_ratio
    assert formats.compare_formats(spark, bases.text, str(tmp_path), ["ratings"]).count() == 0


def test_bucketed_tables_join_without_shuffle(spark, small, tmp_path):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    titles = ingest.save_bucketed(small.titles, "titles", "titles_b", 4, str(tmp_path / "t"))
    ratings = ingest.save_bucketed(small.ratings, "ratings", "ratings_b", 4, str(tmp_path / "r"))
    spark.conf.set(threshold, "-1")
    try:
        joined = titles.join(ratings, "tconst")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 7
    finally:
        spark.conf.set(threshold, before)


def test_scratch_folder_is_below_the_shared_one(spark):
    first, second = scratch_folder(spark, "a"), scratch_folder(spark, "a")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_rejects_and_accepted_rows_are_all_rows(spark, tmp_path):
    columns = "tconst\tprimaryTitle\ttitleType\tisAdult\tstartYear\truntimeMinutes\tgenres"
    lines = [
        "t1\tAlpha\tmovie\t0\t2000\t90\tDrama",
        "t2\tBeta\tmovie\t0\t\\N\t\\N\t\\N",
        "t3\tshort line",
        "t4\tGamma\tmovie\t0\t2000\t90\tDrama\tmore",
        "t5\tDelta\tmovie\t0\tabcd\tn/a\tDrama",
        "\\N\tNobody\tmovie\t0\t2000\t90\tDrama",
        't6\tWith "quotes, and\tmovie\t1\t1999\t5\tA,B',
        "",
    ]
    base = tmp_path / "text"
    base.mkdir()
    with gzip.open(base / "title.basics.tsv.gz", "wt") as target:
        target.write("\n".join([columns, *lines]) + "\n")
    found = rejects.read_checked(spark, str(base / "title.basics.tsv.gz"), "titles")
    assert found.accepted.columns == columns.split("\t")
    assert sorted(rows(found.accepted, "tconst", "startYear", "runtimeMinutes", "genres")) == [
        ("t1", 2000, 90, "Drama"), ("t2", None, None, None), ("t6", 1999, 5, "A,B"),
    ]
    assert found.rejected.columns == rejects.REJECT_COLUMNS
    assert sorted(rows(found.rejected, "reason", "line")) == sorted(
        [
            ("too few fields", lines[2]),
            ("too many fields", lines[3]),
            ("startYear: not a number; runtimeMinutes: not a number", lines[4]),
            ("tconst: missing", lines[5]),
        ]
    )
    assert {r.file for r in found.rejected.collect()} == {"title.basics.tsv.gz"}
    target, beside = rejects.ingest_checked(spark, str(base), str(tmp_path / "typed"), "titles")
    assert spark.read.parquet(target).count() == 3 and spark.read.parquet(beside).count() == 4
    with pytest.raises(ValueError):
        rejects.read_checked(spark, str(base / "title.basics.tsv.gz"), "ratings")


def test_rejects_of_files_without_rows_or_header(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("tconst\taverageRating\tnumVotes\n")
    none = rejects.read_checked(spark, str(tmp_path / "a.tsv"), "ratings")
    assert none.accepted.count() == 0 and none.rejected.count() == 0
    (tmp_path / "b.tsv").write_text("t1\t8.5\t10\nt2\t8.x\t1\n")
    found = rejects.read_checked(spark, str(tmp_path / "b.tsv"), "ratings", ["tconst", "averageRating", "numVotes"])
    assert rows(found.accepted) == [("t1", 8.5, 10)]
    assert rows(found.rejected, "reason", "line") == [("averageRating: not a number", "t2\t8.x\t1")]
