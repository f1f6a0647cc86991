"""The registered queries against their SQL, and the stages of the pipeline."""

from pathlib import Path

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

from marquee.llm import decontamination, jaccard_join, pii, queries

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="the given tables are not here")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    engine = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        engine.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = queries.QUERIES[name](spark, FOLDER)
    wanted = engine.execute(queries.ORACLE[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(got.select(*columns).collect()) == sorted(wanted.fetchall())
    assert sorted(got.columns) == sorted(columns)


def test_stages_keep_what_is_clean(spark):
    docs = queries.read(spark, FOLDER, "documents")
    begun = docs.count()
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        made = stage(spark, docs, FOLDER)
        assert made.columns == docs.columns and made.schema.simpleString() == docs.schema.simpleString()
        if number == 1:
            found = jaccard_join.near_duplicates(spark, docs, 5, 0.8)
            wanted = found.where("doc_id = component_id").count()
            assert made.count() == wanted
        if number == 2:
            found = decontamination.matches(docs, queries.read(spark, FOLDER, "benchmark"))
            assert made.count() == found.where(~decontamination.is_contaminated()).count()
        if number == 3:
            assert made.count() == docs.count()
            assert pii.find_pii(spark, made).where("spans <> ''").count() == 0
            assert made.where(F.length("text") != F.col("n_chars")).join(docs.where(F.length("text") == F.col("n_chars")), "doc_id").count() == 0
        docs = made
    assert 0 < docs.count() < begun
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_stages_take_odd_rows(spark):
    schema = queries.read(spark, FOLDER, "documents").schema
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "mail me: a@b.cd", "en", None, 15), (3, "a b c", None, "s", 5), (3, "a b c", None, "s", 5)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, FOLDER)
        texts = sorted(r.text for r in docs.collect())
        assert texts == (["a b c", "a b c", "mail me: <EMAIL>"] if rows else [])
        corpus_pipeline.pack_sequences(spark, docs, FOLDER).count()


def test_near_duplicates_are_told_apart_by_row(spark):
    schema = queries.read(spark, FOLDER, "documents").schema
    one, two, three = "a b c d e f g", "h i j k l m n", "o p q r s t u"
    rows = [
        (1, one), (2, one), (2, two), (None, one), (None, three), (None, three), (None, " "), (None, " "), (None, None), (4, "v w x"), (5, "v w x"),
    ]
    docs = spark.createDataFrame([(k, text, "en", "s", len(text or "")) for k, text in rows], schema)
    made = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)
    assert made.schema.simpleString() == docs.schema.simpleString()
    wanted = [(1, one), (2, two), (None, three), (None, " "), (None, " "), (None, None), (4, "v w x")]
    assert sorted(((r.doc_id, r.text) for r in made.collect()), key=str) == sorted(wanted, key=str)


def test_language_stage_rejects_what_no_language_knows(spark):
    schema = queries.read(spark, FOLDER, "documents").schema
    plain = "then the other thing was there and the rest"
    rows = [(k, plain, "en") for k in range(3)] + [(5, "中文字符" * 30, None), (6, "zq", None), (7, "12 34", "en"), (8, plain[:30], None), (9, None, "en")]
    docs = spark.createDataFrame([(k, t, lang, "s", len(t or "")) for k, t, lang in rows], schema)
    clashing = docs.withColumn("score", F.lit("own")).withColumn("lang_pred", F.lit(3))
    made = corpus_pipeline.identify_language(spark, clashing, FOLDER)
    assert made.columns == clashing.columns
    assert sorted(r.doc_id for r in made.collect()) == [0, 1, 2, 6, 8]
    assert made.select("score", "lang_pred").distinct().collect() == [("own", 3)]


def test_hashes_that_meet_are_told_apart(spark, monkeypatch):
    """Whole numbers for rows, also where half of the hashes are equal; rows alike keep one number."""
    schema = queries.read(spark, FOLDER, "documents").schema
    rows = [(k // 2, f"t{k}", "en", "s", 2) for k in range(40)] + [(0, "t0", "en", "s", 2), (None, None, None, None, None), (None, "", None, None, 0)]
    docs = spark.createDataFrame(rows, schema).withColumn("checksum", F.lit("own"))
    monkeypatch.setattr(corpus_pipeline, "row_hash", lambda: F.pmod(F.xxhash64("doc_id", "text"), F.lit(8)))
    made = corpus_pipeline.with_mark(docs, "mark")
    assert made.columns == [*docs.columns, "mark"]
    numbers = {}
    for r in made.collect():
        numbers.setdefault(r.mark, set()).add((r.doc_id, r.text))
    assert len(numbers) == 42 and all(len(v) == 1 for v in numbers.values())


def test_long_passages_are_cut_out_of_documents_that_stay(spark):
    schema = queries.read(spark, FOLDER, "documents").schema
    item = queries.read(spark, FOLDER, "benchmark").where("size(split(text, ' ')) > 55").orderBy("item_id").first()
    if item is None:
        pytest.skip("no item of over 55 words here")
    rest = " ".join(f"w{k}x" for k in range(3000))
    rows = [(1, f"{rest} {item.text} {rest}"), (2, item.text), (3, rest)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], schema)
    made = {r.doc_id: r for r in corpus_pipeline.decontaminate(spark, docs, FOLDER).collect()}
    assert sorted(made) == [1, 3] and made[3].text == rest
    assert len(made[1].text) < len(rows[0][1]) - 100 and made[1].text.startswith(rest) and made[1].n_chars == len(made[1].text)
