"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that its predecessor kept, written and read again, and all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import decontamination, jaccard_join, language_id, pii, queries
from marquee.llm.storage import drop, stored
from marquee.operators.skew import spread_join


#: A text of so many characters has enough n-grams for its language to be known by one of them at least.
TELLING = 20


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Documents that are null or without letters go, and those of which no language has an n-gram, unless they are shorter than 20 characters.

    The filters are learned from the rows with a language.
    """
    filters = language_id.fit(docs.where(F.col("lang").isNotNull()))
    # Columns of the names that the prediction adds are kept apart.
    apart = {c: fresh(docs, c) for c in ("lang_pred", "score") if c in docs.columns}
    predicted = language_id.predict(docs.withColumnsRenamed(apart), filters)
    known = (F.col("lang_pred") != language_id.UNKNOWN) & ((F.col("score") > 0) | (F.char_length("text") < TELLING))
    kept = predicted.where(known).drop("lang_pred", "score")
    return kept.withColumnsRenamed({new: old for old, new in apart.items()}).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Of documents linked by five-word shingles of a similarity of 0.8 the one of the smallest id stays, nulls last.

    Documents without words are no duplicates.  Texts that share an id are told apart; rows alike in
    id and text are one document and stay or go together, but of those without an id one stays.
    """
    mark, rank, best = fresh(docs, "mark"), fresh(docs, "rank"), fresh(docs, "best")
    marked = with_mark(docs, mark)
    found = jaccard_join.near_duplicates(spark, marked, width=5, threshold=0.8, id_column=mark)
    linked = found.where(F.col(mark) != F.col("component_id")).select(F.col(mark).alias("node"), F.col("component_id").alias("root")).distinct()
    linked = stored(spark, linked, "linked")
    members = linked.unionByName(linked.select(F.col("root").alias("node"), "root").distinct())
    named = marked.select(F.col(mark).alias("node"), "doc_id").join(members, "node").distinct()
    named = stored(spark, named.withColumn(rank, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")), "members")
    # A group may hold a third of all documents: its rows are spread over many tasks.
    first = named.groupBy("root").agg(F.min(rank).alias(best))
    copies = spread_join(named, first, "root", ["node"]).where(F.col(rank) != F.col(best)).select(F.col("node").alias(mark))
    kept = marked.join(copies, mark, "left_anti")
    # Rows without an id whose texts are equal are copies, too.
    single = F.col("doc_id").isNull() & F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    alone = kept.where(single).groupBy(mark).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return kept.where(~single).select(*docs.columns).unionByName(alone)


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def row_hash() -> Column:
    return F.xxhash64("doc_id", "text")


def with_mark(docs: DataFrame, mark: str) -> DataFrame:
    """Adds a whole number that two rows share if they share id and text, and only then.

    It is a hash of 64 bits.  Of so many documents that some of these meet, those that do are told apart by a checksum of 256 bits: n
    documents have about n * n / 2 ** 65 such hashes, three of ten thousand million, which is what is broadcast.
    """
    hashed, checksum = row_hash(), fresh(docs, "checksum")
    own = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.col("text").isNull(), F.coalesce("text", F.lit("")))
    both = docs.select(hashed.alias("hash"), F.sha2(own, 256).alias("sum"))
    met = both.groupBy("hash").agg(F.min("sum").alias("low"), F.max("sum").alias("high")).where("low <> high")
    met = F.broadcast(stored(docs.sparkSession, met.select(F.col("hash").alias(mark), F.lit(True).alias(checksum)), "clashes"))
    told = F.when(F.col(checksum), F.xxhash64(F.col(mark), F.sha2(own, 256))).otherwise(F.col(mark))
    return docs.withColumn(mark, hashed).join(met, mark, "left").withColumn(mark, told).select(*docs.columns, mark)


#: Test passages of over so many words are cut out of documents that stay.
LONGEST_PASSAGE = 50


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more stands in test items go; of others, passages of over 50 words.

    ``n_chars`` follows a text that is cut.
    """
    name, bad = fresh(docs, "key"), fresh(docs, "found")
    marked = docs.withColumn(name, key())
    found = decontamination.matches(marked, queries.read(spark, sf_dir, "benchmark"), id_column=name)
    found = found.withColumn("gone", decontamination.is_contaminated())
    found = found.withColumn("cuts", decontamination.long_spans(LONGEST_PASSAGE)).where("gone OR size(cuts) > 0")
    found = found.select(F.col(name).alias(bad), F.struct("gone", "cuts").alias("what")).distinct()
    joined = marked.join(found.withColumnRenamed("what", fresh(marked, "what")), F.col(name).eqNullSafe(F.col(bad)), "left")
    what = F.col(fresh(marked, "what"))
    stays = joined.where(~F.coalesce(what["gone"], F.lit(False)))
    text = F.when(what.isNotNull(), decontamination.cut_out(F.col("text"), what["cuts"])).otherwise(F.col("text"))
    count = F.when(what.isNotNull(), F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    # One after the other: a count beside the new text would partly read the old one.
    return stays.withColumn("text", text).withColumn("n_chars", count).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Personal data are replaced by the name of their kind; ``n_chars`` follows."""
    name, other, spans = fresh(docs, "key"), fresh(docs, "found"), fresh(docs, "spans")
    marked = docs.withColumn(name, key())
    found = pii.find_pii(spark, marked, name).where("spans <> ''").select(F.col(name).alias(other), F.col("spans").alias(spans)).distinct()
    joined = marked.join(found, F.col(name).eqNullSafe(F.col(other)), "left")
    text = pii.mask_column(F.col("text"), F.coalesce(spans, F.lit("")))
    changed = joined.withColumn("text", text)
    count = F.when(F.col(spans).isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return changed.withColumn("n_chars", count).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Where each piece of each document goes in sequences of 1024 tokens."""
    return queries.pack(spark, docs)


def key() -> Column:
    """A document's id and a hash of its text, so that rows that share an id are told apart."""
    return F.struct("doc_id", F.xxhash64("text").alias("mark"))


STAGES = [
    ("language identification", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("personal data", mask_personal_data),
    ("best-fit packing", pack_sequences),
]

#: Learned filters, bootstrapped contexts and the packing plan are not SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        last, docs = docs, stored(spark, stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
        # Only what a stage has written is dropped, never the given table.
        drop(spark, last)
    return STAGES[-1][1](spark, docs, sf_dir)
