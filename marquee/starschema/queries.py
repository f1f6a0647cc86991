"""One named query per capability over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps
from math import ceil
from multiprocessing.pool import ThreadPool
from operator import add

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.functions.columns import settled
from marquee.models import embeddings, factors, features, predictor, recommender, selection
from marquee.operators import gram, lsh, neighbours, quantiles, shaping
from marquee.plans import crew, genres, places, ratings, runtime, trends
from marquee.schemas import TABLES
from marquee.sources import catalogue, formats, ingest, rejects
from marquee.sources.scratch import scratch_folder, stored_once
from marquee.starschema.views import StarCatalogue

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

POPULARITY = ("weighted_popularity", "popularity_change")
# Ratings of the test tables centre on 5, so the usual floor of 8 would keep nobody.
HIGH_RATING, HIGH_TITLES = 5.7321, 5
STAR_KEYS = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
    "events": "event_id",
    "embeddings": "vec_id",
    "documents": "doc_id",
    "pages": "page_id",
    "benchmark": "item_id",
    "labels": "doc_id",
    "conversations": "conv_id",
}


def query(build: Callable[[StarCatalogue], DataFrame]) -> Callable[[StarCatalogue], DataFrame]:
    """Register a query; its fractional results are rounded to six digits.

    The small shift moves exact ties off the rounding edge, where engines differ.
    Popularity is a mean times up to millions of votes, of which three digits are sure.
    """

    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = build(StarCatalogue(spark, folder))
        return result.select(*(shown(c, kind) for c, kind in result.dtypes))

    QUERIES[build.__name__] = run
    return build


def shown(name: str, kind: str) -> Column:
    value = F.col(name)
    if name in POPULARITY:
        value = F.round(value + F.lit(1e-6), 3)
    elif kind == "double":
        value = F.round(value + F.lit(1e-9), 6)
    return value.alias(name)


def as_double(frame: DataFrame, *columns: str) -> DataFrame:
    """Whole numbers with nulls among them, shown as doubles: pandas does so on one side only."""
    return frame.withColumns({c: F.col(c).cast("double") for c in columns})


# Sources and sinks


@query
def load_parquet(star: StarCatalogue) -> DataFrame:
    parts = [
        star.star(table).agg(
            F.lit(table).alias("table_name"), F.count("*").alias("num_rows"), F.sum(key).cast("long").alias("key_sum")
        )
        for table, key in STAR_KEYS.items()
    ]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part)
    return joined


@query
def read_tsv(star: StarCatalogue) -> DataFrame:
    path = scratch_folder(star.spark, "tsv")
    ingest.write_text(star.raw("titles"), path)
    return as_double(catalogue.read_text(star.spark, path, "titles"), "startYear", "runtimeMinutes")


@query
def ingest_tsv_to_parquet(star: StarCatalogue) -> DataFrame:
    base = scratch_folder(star.spark, "ingest")
    ingest.write_text(star.raw("ratings"), catalogue.join_path(base, TABLES["ratings"].text_file))
    ingest.ingest(star.spark, base, base, "ratings")
    return catalogue.Catalogue(star.spark, base, ingested=True).ratings()


@query
def ingest_rejects(star: StarCatalogue) -> DataFrame:
    """Titles as text without a header, some lines cut short, too long or with bad numbers: rows per reason, and accepted ones."""
    base = scratch_folder(star.spark, "rejects")
    raw = star.raw("titles")
    key = F.col("tconst").cast("long")
    short = F.concat_ws("\t", *raw.columns[:-2])
    whole = F.concat_ws("\t", *raw.columns)
    line = F.when(key % 97 == 0, short).when(key % 89 == 0, F.concat_ws("\t", whole, F.lit("extra"))).otherwise(whole)
    raw.select(line.alias("value")).write.text(catalogue.join_path(base, TABLES["titles"].text_file), compression="gzip")
    accepted, beside = rejects.ingest_checked(star.spark, base, base, "titles", raw.columns)
    fitting = catalogue.read_columnar(star.spark, accepted).select(F.lit("accepted").alias("reason"), F.col("tconst").alias("_key"))
    others = catalogue.read_columnar(star.spark, beside).select("reason", F.get(F.split("line", "\t"), F.lit(0)).alias("_key"))
    counts = fitting.unionByName(others).groupBy("reason")
    return counts.agg(F.count("*").alias("num_rows"), F.sum(F.col("_key").cast("long")).alias("key_sum"))


def _filled(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, and how many of all its cells are not null."""
    parts = [
        frame.agg(
            F.lit(table).alias("table_name"),
            F.count("*").alias("num_rows"),
            reduce(add, (F.count(c) for c in frame.columns)).alias("filled"),
        )
        for table, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _all_at_once(store: Callable[[str], object]) -> None:
    with ThreadPool(len(TABLES)) as jobs:
        jobs.map(store, TABLES)


@query
def load_catalogue(star: StarCatalogue) -> DataFrame:
    """All seven tables from Parquet that holds text and null markers."""
    base = scratch_folder(star.spark, "marked")
    _all_at_once(lambda table: star.raw(table).write.parquet(catalogue.join_path(base, TABLES[table].parquet_dir)))
    loaded = catalogue.Catalogue(star.spark, base)
    return _filled({table: loaded.table(table) for table in TABLES})


@query
def ingest_all_tables(star: StarCatalogue) -> DataFrame:
    """All seven tables as text, ingested to typed Parquet."""
    base = scratch_folder(star.spark, "all")

    def store(table: str) -> None:
        ingest.write_text(star.raw(table), catalogue.join_path(base, TABLES[table].text_file))
        ingest.ingest(star.spark, base, base, table)

    _all_at_once(store)
    loaded = catalogue.Catalogue(star.spark, base, ingested=True)
    return _filled({table: loaded.table(table) for table in TABLES})


@query
def write_csv(star: StarCatalogue) -> DataFrame:
    path = scratch_folder(star.spark, "csv")
    ingest.write_csv(genres.genre_trends(star.titles, star.ratings), path)
    return catalogue.read_comma_text(star.spark, path).select(
        F.col("startYear").cast("int"),
        "genre",
        F.col("avg_rating").cast("double"),
        F.col("title_count").cast("long"),
        F.col("total_votes").cast("long"),
        F.col("genre_rank").cast("int"),
    )


@query
def table_schemas(star: StarCatalogue) -> DataFrame:
    keys = {table: source.order for table, source in TABLES.items()}
    return catalogue.table_schemas({table: star.raw(table) for table in TABLES}, order_by=keys)


@query
def format_comparison(star: StarCatalogue) -> DataFrame:
    base = scratch_folder(star.spark, "formats")

    def store(table: str) -> None:
        frame = star.raw(table)
        ingest.write_text(frame, catalogue.join_path(base, TABLES[table].text_file))
        frame.write.parquet(catalogue.join_path(base, TABLES[table].parquet_dir))

    _all_at_once(store)
    compared = formats.compare_formats(star.spark, base, base)
    saved = (1 - F.col("parquet_size") / F.col("tsv_size")) * 100
    return compared.select(
        "dataset",
        "tsv_count",
        "parquet_count",
        (F.col("tsv_count") == F.col("parquet_count")).alias("same_rows"),
        ((F.col("tsv_size") > 0) & (F.col("parquet_size") > 0)).alias("both_stored"),
        (F.abs(F.col("compression_ratio") - saved) < 1e-6).alias("ratio_holds"),
        formats.format_summary(compared).select("datasets").scalar().alias("datasets"),
    )


# Cleaning


@query
def clean_drop_nulls(star: StarCatalogue) -> DataFrame:
    kept = shaping.handle_nulls(star.titles, ["startYear", "runtimeMinutes"], "drop")
    return kept.select("tconst", "startYear", "runtimeMinutes")


@query
def clean_fill_nulls(star: StarCatalogue) -> DataFrame:
    filled = shaping.handle_nulls(star.titles, ["runtimeMinutes", "genres"], "fill")
    return filled.select("tconst", "runtimeMinutes", "genres")


@query
def clean_fill_map(star: StarCatalogue) -> DataFrame:
    return shaping.fill_with(star.titles, {"genres": "", "startYear": -1}).select("tconst", "startYear", "genres")


@query
def clean_dedupe(star: StarCatalogue) -> DataFrame:
    return shaping.one_per_key(star.raw("principals"), ["nconst", "category"], ["tconst", "job"])


@query
def null_markers(star: StarCatalogue) -> DataFrame:
    return as_double(shaping.normalise(star.raw("titles"), "titles"), "startYear", "runtimeMinutes")


@query
def typed_ratings(star: StarCatalogue) -> DataFrame:
    return shaping.normalise(star.raw("ratings"), "ratings")


@query
def relevant_titles(star: StarCatalogue) -> DataFrame:
    return shaping.relevant_titles(star.titles).select("tconst", "titleType", "genres")


@query
def nonempty_genre_list(star: StarCatalogue) -> DataFrame:
    kept = embeddings.with_genre_list(star.titles)
    return kept.select("tconst", F.get("genres_array", F.lit(0)).alias("first_genre"), F.size("genres_array").alias("size"))


# Joins


@query
def join_titles_ratings_left(star: StarCatalogue) -> DataFrame:
    joined = shaping.with_ratings(star.titles, star.ratings)
    return as_double(joined, "numVotes").select("tconst", "titleType", "averageRating", "numVotes")


@query
def join_titles_ratings_inner(star: StarCatalogue) -> DataFrame:
    joined = shaping.with_ratings(star.titles, star.ratings, "inner")
    return joined.select("tconst", "titleType", "averageRating", "numVotes")


@query
def join_three_way(star: StarCatalogue) -> DataFrame:
    rated = shaping.with_ratings(star.titles, star.ratings, "inner")
    joined = shaping.with_crew(rated, star.crew, "inner")
    return joined.select("tconst", "averageRating", "directors", "writers")


# Genres


@query
def genre_distribution(star: StarCatalogue) -> DataFrame:
    return genres.genre_distribution(star.titles)


@query
def genre_rating_correlation(star: StarCatalogue) -> DataFrame:
    return genres.genre_rating_correlation(star.titles, star.ratings)


@query
def genre_popularity(star: StarCatalogue) -> DataFrame:
    return genres.genre_popularity(star.titles, star.ratings)


@query
def genre_popularity_with_crew(star: StarCatalogue) -> DataFrame:
    return genres.genre_popularity(star.titles, star.ratings, crew=star.crew)


@query
def genre_trends(star: StarCatalogue) -> DataFrame:
    return genres.genre_trends(star.titles, star.ratings)


@query
def genre_popularity_by_region(star: StarCatalogue) -> DataFrame:
    return genres.genre_popularity_by(star.titles, star.akas, star.ratings, "region")


@query
def genre_popularity_by_language(star: StarCatalogue) -> DataFrame:
    return genres.genre_popularity_by(star.titles, star.akas, star.ratings, "language")


@query
def emerging_declining_genres(star: StarCatalogue) -> DataFrame:
    return genres.emerging_declining_genres(star.titles, star.ratings)


@query
def top_rated_genre(star: StarCatalogue) -> DataFrame:
    return genres.top_rated_genres(star.titles, star.ratings)


@query
def genre_consistency(star: StarCatalogue) -> DataFrame:
    return genres.genre_consistency(star.titles, star.ratings)


@query
def audience_preferences_by_genre(star: StarCatalogue) -> DataFrame:
    return genres.audience_preferences_by_genre(star.titles, star.ratings)


@query
def most_consistent_genres(star: StarCatalogue) -> DataFrame:
    return genres.consistent_genres(star.titles, star.ratings, most=True)


@query
def most_inconsistent_genres(star: StarCatalogue) -> DataFrame:
    return genres.consistent_genres(star.titles, star.ratings, most=False)


# Ratings and types


@query
def top_rated_title_type(star: StarCatalogue) -> DataFrame:
    return ratings.ratings_by_title_type(star.titles, star.ratings)


@query
def ratings_by_title_type(star: StarCatalogue) -> DataFrame:
    return ratings.ratings_by_title_type(star.titles, star.ratings)


@query
def top_rated_overall(star: StarCatalogue) -> DataFrame:
    return ratings.top_rated_titles(star.titles, star.ratings)


@query
def top_rated_movies_chart(star: StarCatalogue) -> DataFrame:
    return ratings.top_rated_titles(star.titles, star.ratings).select("primaryTitle", "averageRating")


@query
def rating_distribution(star: StarCatalogue) -> DataFrame:
    return ratings.rating_distribution(star.titles, star.ratings)


@query
def rating_ranges(star: StarCatalogue) -> DataFrame:
    return ratings.rating_ranges(star.titles, star.ratings)


@query
def rating_histogram(star: StarCatalogue) -> DataFrame:
    return ratings.rating_histogram(star.titles, star.ratings)


@query
def rating_boxplot_by_title_type(star: StarCatalogue) -> DataFrame:
    return ratings.rating_boxplot_by_title_type(star.titles, star.ratings)


@query
def rating_variance_by_title_type(star: StarCatalogue) -> DataFrame:
    return ratings.rating_variance_by_title_type(star.titles, star.ratings)


# Runtime, places, time


@query
def rating_density(star: StarCatalogue) -> DataFrame:
    return ratings.rating_density(star.titles, star.ratings)


@query
def price_quantile_sketches(star: StarCatalogue) -> DataFrame:
    """Sketches per flag and status, merged per flag: rows, and whether the quartiles' ranks are within the stated error."""
    lines = star.star("lineitem")
    fine = quantiles.quantile_sketches(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice")
    found = quantiles.sketched_quantiles(quantiles.merged_sketches(fine, ["l_returnflag"]), ["l_returnflag"])
    gaps = quantiles.rank_gap(lines, found, "l_returnflag", "l_extendedprice", [0.25, 0.5, 0.75])
    # The stated error holds in 99 of 100 cases; three times it, always.
    close = (F.col("gap") <= 3 * quantiles.rank_error()).alias("within_error")
    return found.join(gaps, "l_returnflag").select("l_returnflag", "n", close)


@query
def rating_boxplot_sketched(star: StarCatalogue) -> DataFrame:
    """Box plots from sketches: rows per type, and whether whiskers and outliers fit the quartiles."""
    boxes = ratings.rating_boxplot_sketched(star.titles, star.ratings)
    inside = (F.col("whisker_low") <= F.col("q1")) & (F.col("q1") <= F.col("median")) & (F.col("q3") <= F.col("whisker_high"))
    return boxes.select("titleType", "n", inside.alias("in_order"), (F.col("n_outliers") <= F.col("n") / 4).alias("few_outliers"))


@query
def embedding_correlation(star: StarCatalogue) -> DataFrame:
    return gram.vector_correlations(star.star("embeddings"), "embedding")


@query
def runtime_rating_pairs(star: StarCatalogue) -> DataFrame:
    return runtime.runtime_rating_pairs(star.titles, star.ratings)


@query
def runtime_rating_correlation(star: StarCatalogue) -> DataFrame:
    return runtime.runtime_rating_correlation(star.titles, star.ratings)


@query
def runtime_perception(star: StarCatalogue) -> DataFrame:
    return runtime.runtime_perception(star.titles, star.ratings)


@query
def ratings_by_region(star: StarCatalogue) -> DataFrame:
    return places.ratings_by_region(star.akas, star.ratings)


@query
def top_regions(star: StarCatalogue) -> DataFrame:
    return places.top_regions(star.akas, star.ratings)


@query
def content_type_trends(star: StarCatalogue) -> DataFrame:
    return trends.content_type_trends(star.titles)


# Crew


@query
def director_productivity(star: StarCatalogue) -> DataFrame:
    return crew.director_productivity(star.crew)


@query
def job_distribution(star: StarCatalogue) -> DataFrame:
    return crew.job_distribution(star.principals)


@query
def multi_role_people(star: StarCatalogue) -> DataFrame:
    people = crew.multi_role_people(star.principals)
    return people.withColumn("roles", F.array_join("roles", ","))


@query
def collaboration_network(star: StarCatalogue) -> DataFrame:
    return crew.collaboration_network(star.principals)


@query
def crew_contribution(star: StarCatalogue) -> DataFrame:
    return crew.crew_contribution(star.titles, star.crew, star.ratings)


@query
def crew_contribution_lists(star: StarCatalogue) -> DataFrame:
    best = crew.crew_contribution(star.titles, star.crew, star.ratings, as_lists=True)
    return best.withColumn("titles", F.array_join("titles", "|"))


def _crew_inputs(star: StarCatalogue) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return star.titles, star.ratings, star.crew, star.principals


@query
def director_writer_performance(star: StarCatalogue) -> DataFrame:
    return as_double(crew.crew_performance(*_crew_inputs(star)), "total_votes")


@query
def crew_performance_and_ratings(star: StarCatalogue) -> DataFrame:
    return as_double(crew.crew_performance(*_crew_inputs(star)), "total_votes")


@query
def high_performing_crew(star: StarCatalogue) -> DataFrame:
    return crew.high_performing_crew(*_crew_inputs(star), min_rating=HIGH_RATING, min_titles=HIGH_TITLES)


@query
def top_performers_chart(star: StarCatalogue) -> DataFrame:
    return crew.top_performers(*_crew_inputs(star), min_rating=HIGH_RATING, min_titles=HIGH_TITLES)


@query
def crew_correlation_chart(star: StarCatalogue) -> DataFrame:
    return crew.crew_scatter(*_crew_inputs(star))


@query
def director_consistency(star: StarCatalogue) -> DataFrame:
    return crew.director_consistency(star.titles, star.ratings, star.crew)


@query
def writer_consistency(star: StarCatalogue) -> DataFrame:
    return crew.writer_consistency(star.titles, star.ratings, star.crew)


# Models


@query
def genre_index(star: StarCatalogue) -> DataFrame:
    return features.prepare_features(star.titles).select("tconst", "genres", "genreIndex")


@query
def genre_one_hot(star: StarCatalogue) -> DataFrame:
    encoded = features.prepare_features(star.titles).withColumn("cells", vector_to_array("genreVec"))
    return encoded.select(
        "tconst",
        (F.array_position("cells", F.lit(1.0)) - 1).alias("hot"),
        F.size("cells").alias("size"),
    )


@query
def genre_multi_hot(star: StarCatalogue) -> DataFrame:
    """A mark per genre, most frequent genre first; titles without genres have none."""
    terms = star.titles.select("tconst", F.coalesce(F.split("genres", ","), F.array(F.lit(""))).alias("terms"))
    marked = features.multi_hot(features.fit_vocabulary(terms, "terms"), "terms", "marks").transform(terms)
    cells = F.transform(vector_to_array("marks"), lambda x: x.cast("int").cast("string"))
    return marked.select("tconst", F.array_join(cells, ",").alias("marks"))


def _with_credits(star: StarCatalogue) -> DataFrame:
    """Rated titles with the number of their credits."""
    credits = star.principals.groupBy("tconst").agg(F.count("*").alias("credits"))
    rated = shaping.with_ratings(star.titles, star.ratings, "inner")
    return rated.join(credits, "tconst").select("tconst", "genres", "runtimeMinutes", "credits", "numVotes")


@query
def votes_prediction(star: StarCatalogue) -> DataFrame:
    """A forest chosen by cross-validation, saved and loaded again: does it err at most 0.75 times as much as the mean does?"""
    numbers = ["credits", "runtimeMinutes"]
    train, test = predictor.split_by_key(stored_once(_with_credits(star), "credited"))
    chosen = selection.TitleForest("numVotes", numbers, trees=[10], depths=[2, 5]).fit(train)
    path = scratch_folder(star.spark, "forest")
    chosen.save(path)
    loaded = selection.TitleForest.load(path, "numVotes", numbers)
    before = chosen.predict(test).select("tconst", F.col("prediction").alias("before"))
    both = loaded.predict(test).join(before, "tconst")
    same = F.count_if(F.col("prediction") == F.col("before")).alias("same_after_loading")
    error = F.sqrt(F.avg(F.pow(F.col("numVotes") - F.col("prediction"), F.lit(2.0))))
    return both.agg(
        F.count("*").alias("titles"),
        same,
        F.lit(len(chosen.trials(star.spark).collect())).cast("long").alias("trials"),
        (error <= 0.75 * F.stddev_pop("numVotes")).alias("beats_the_mean"),
    )


@query
def votes_prediction_unseen(star: StarCatalogue) -> DataFrame:
    """Trained without dramas: titles of combinations never seen still get predictions from their single genres and numbers."""
    whole = stored_once(_with_credits(star), "credited")
    drama = F.coalesce(F.col("genres").contains("Drama"), F.lit(False))
    fitted = selection.TitleForest("numVotes", ["credits"], trees=[10], depths=[5], folds=2).fit(whole.where(~drama))
    predicted = fitted.predict(whole.where(drama))
    error = F.sqrt(F.avg(F.pow(F.col("numVotes") - F.col("prediction"), F.lit(2.0))))
    return predicted.agg(
        F.count("*").alias("titles"),
        F.count("prediction").alias("scored"),
        (error <= 0.75 * F.stddev_pop("numVotes")).alias("beats_the_mean"),
    )


@query
def rating_prediction(star: StarCatalogue) -> DataFrame:
    rated = shaping.with_ratings(star.titles, star.ratings, "inner").select("tconst", "genres", "averageRating")
    train, test = predictor.split_by_key(stored_once(rated, "rated"))
    predicted = predictor.RatingPredictor().fit(train).predict(test)
    seen = train.where(F.col("genres").isNotNull()).select("genres").distinct().withColumn("seen", F.lit(True))
    # Combinations of genres, of which the fitted model holds a list, too.  Joined by shuffles, all titles of one would meet in a task.
    marked = predicted.join(F.broadcast(seen), "genres", "left")
    error = F.sqrt(F.avg(F.pow(F.col("averageRating") - F.col("prediction"), F.lit(2.0))))
    return marked.agg(
        F.count("*").alias("titles"),
        F.count_if(F.col("seen").isNull()).alias("unseen"),
        F.count("prediction").alias("scored"),
        (error <= 1.05 * F.stddev_pop("averageRating")).alias("no_worse_than_the_mean"),
    )


@query
def genre_embeddings(star: StarCatalogue) -> DataFrame:
    listed = embeddings.rated_genre_lists(star.titles, star.ratings)
    model = embeddings.fit_genre_vectors(listed)
    return embeddings.embed(model, listed).select("tconst", "genres", "genre_embedding")


@query
def genre_embedding_check(star: StarCatalogue) -> DataFrame:
    """Per genre list: its titles, how long their vectors are, and how many different ones they have."""
    listed = embeddings.rated_genre_lists(star.titles, star.ratings)
    embedded = embeddings.embed(embeddings.fit_genre_vectors(listed), listed)
    return embedded.groupBy("genres").agg(
        F.count("*").alias("titles"),
        F.max(F.size("genre_embedding")).alias("length"),
        F.count_distinct("genre_embedding").alias("vectors"),
    )


@query
def item_similarity(star: StarCatalogue) -> DataFrame:
    similar = recommender.similarity_to(star.star("embeddings"), "vec_id", "embedding", 0)
    return similar.select("vec_id", "similarity")


@query
def similar_items_topk(star: StarCatalogue) -> DataFrame:
    return neighbours.nearest_items(star.star("embeddings"), "vec_id", "embedding")


#: Tables of planes, planes of each and items of a block, for the given vectors, which have no clusters.
HASHING = lsh.Hashing(tables=16, planes=16, block=128)


@query
def similar_items_lsh(star: StarCatalogue) -> DataFrame:
    return lsh.approximate_neighbours(star.star("embeddings"), "vec_id", "embedding", how=HASHING)


@query
def similar_items_lsh_recall(star: StarCatalogue) -> DataFrame:
    """What share of the exact neighbours the approximate ones hold, and how many products that takes."""
    items = star.star("embeddings")
    found = lsh.approximate_neighbours(items, "vec_id", "embedding", how=HASHING)
    exact = neighbours.nearest_items(items, "vec_id", "embedding")
    # One row on both sides.
    both = lsh.recall(found, exact, "vec_id").crossJoin(F.broadcast(lsh.compared_pairs(items, "vec_id", "embedding", HASHING)))
    return both.select("neighbours", "recall", (F.col("recall") >= 0.9).alias("enough"), "compared", "all_pairs")


@query
def similar_titles_topk(star: StarCatalogue) -> DataFrame:
    return recommender.TitleRecommender().fit(star.titles, star.ratings).similar_titles()


#: Titles whose neighbours are looked at in one task.
TITLES_OF_A_TASK = 50_000


@query
def similar_titles_check(star: StarCatalogue) -> DataFrame:
    """Per title: its neighbours, whether their ranks are gapless and in order, and, where over ten other titles have its
    genres, whether all of them are as good as alike."""
    fitted = recommender.TitleRecommender().fit(star.titles, star.ratings)
    # The number of parts follows the rows: Spark goes by bytes, and neighbours of titles alike shrink to nearly none on the way.
    tasks = int(star.spark.conf.get("spark.sql.shuffle.partitions"))
    found = fitted.similar_titles().repartition(max(tasks, ceil(fitted.items.count() / TITLES_OF_A_TASK)), "tconst")
    later = F.lead("similarity").over(Window.partitionBy("tconst").orderBy("rank"))
    falls = F.coalesce(settled(F.col("similarity")) >= settled(later), F.lit(True))
    listed = embeddings.rated_genre_lists(star.titles, star.ratings).select("tconst", "genres")
    crowded = listed.groupBy("genres").agg((F.count("*") > 10).alias("crowded"))
    checked = found.withColumn("falls", falls).groupBy("tconst").agg(
        F.count_distinct("neighbour").alias("neighbours"),
        (F.bool_and("falls") & (F.max("rank") == F.count("*"))).alias("in_order"),
        F.count_if(F.col("neighbour") == F.col("tconst")).alias("itself"),
        F.min("similarity").alias("least"),
    )
    # Combinations of genres are few; joined by shuffles, all titles of one would meet in a task.
    joined = checked.join(listed, "tconst").join(F.broadcast(crowded), "genres")
    alike = F.when(F.col("crowded"), F.col("least") > 1 - 1e-6)
    return joined.select("tconst", "neighbours", "in_order", "itself", F.coalesce(alike, F.lit(True)).alias("alike"))


@query
def title_recommendations_check(star: StarCatalogue) -> DataFrame:
    """Recommendations for one title, half by genre: how many, whether in order and without itself, and the score recomputed."""
    best = recommender.TitleRecommender().fit(star.titles, star.ratings).recommend("1", alpha=0.5)
    scores = factors.one_user_scores(embeddings.rated_genre_lists(star.titles, star.ratings), "tconst", "averageRating")
    both = best.join(scores.withColumnRenamed("cf_score", "closed"), "tconst")
    blended = F.abs(F.col("score") - (0.5 * F.col("similarity") + 0.5 * F.col("closed"))) < 1e-9
    # No title that is left out beats the last one: one as alike as can be, of the best rating there is.
    top = F.max("closed").over(Window.partitionBy())
    return both.withColumn("top", top).agg(
        F.count("*").alias("titles"),
        F.count_if(F.col("tconst") == "1").alias("itself"),
        F.bool_and(blended).alias("blended"),
        F.bool_and(F.col("score") <= 0.5 + 0.5 * F.col("top") + 1e-9).alias("bounded"),
    )


@query
def als_scores(star: StarCatalogue) -> DataFrame:
    rated = embeddings.rated_genre_lists(star.titles, star.ratings)
    return factors.one_user_scores(rated, "tconst", "averageRating")


@query
def als_factor_scores(star: StarCatalogue) -> DataFrame:
    """The factorisation over customers and parts: rows, and how close it comes."""
    rated = _part_ratings(star)
    scored = stored_once(factors.factor_scores(rated, "o_custkey", "l_partkey", "rating"), "scores")
    scored = scored.join(rated, ["o_custkey", "l_partkey"])
    error = F.avg(F.pow(F.col("rating") - F.col("cf_score"), F.lit(2.0)))
    return scored.agg(
        F.count("*").alias("pairs"),
        (F.min("cf_score") >= 0).alias("not_negative"),
        (error < F.var_pop("rating")).alias("better_than_the_mean"),
    )


def _part_ratings(star: StarCatalogue) -> DataFrame:
    """Customers, parts and mean quantities, stored since a factorisation reads them several times."""
    lines = star.star("lineitem").join(star.star("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rated = lines.groupBy("o_custkey", "l_partkey").agg(F.avg("l_quantity").cast("double").alias("rating"))
    return stored_once(rated, "part-ratings")


@query
def als_recommendations(star: StarCatalogue) -> DataFrame:
    """Per customer, ten parts of the best score: how many, which ranks, how many of them were rated before, scores in order."""
    rated = _part_ratings(star)
    fitted = factors.fit_factors(rated, "o_custkey", "l_partkey", "rating").save(scratch_folder(star.spark, "factors"))
    best = stored_once(fitted.recommend(10), "recommended")
    before = rated.select("o_custkey", "l_partkey", F.lit(1).alias("before"))
    marked = best.join(before, ["o_custkey", "l_partkey"], "left")
    later = F.lead("cf_score").over(Window.partitionBy("o_custkey").orderBy("rank"))
    return marked.withColumn("falls", F.coalesce(settled(F.col("cf_score")) >= settled(later), F.lit(True))).groupBy("o_custkey").agg(
        F.count_distinct("l_partkey").alias("parts"),
        F.min("rank").alias("first_rank"),
        F.max("rank").alias("last_rank"),
        F.count("before").alias("rated_before"),
        F.bool_and("falls").alias("in_order"),
    )


@query
def als_audience(star: StarCatalogue) -> DataFrame:
    """Per part of every hundredth number, five customers who have not bought it."""
    rated = _part_ratings(star)
    fitted = factors.fit_factors(rated, "o_custkey", "l_partkey", "rating", iterations=3)
    asked = star.star("part").where("p_partkey % 100 = 0").select(F.col("p_partkey").alias("l_partkey"))
    best = stored_once(fitted.audience(5, asked), "audience")
    pair = ["o_custkey", "l_partkey"]
    # Few pairs are found, so that those rated before are looked up by a semi join, which need not shuffle the ratings.
    before = rated.select(*pair).join(best.select(*pair), pair, "left_semi").withColumn("before", F.lit(1))
    marked = best.join(before, pair, "left")
    return marked.groupBy("l_partkey").agg(
        F.count_distinct("o_custkey").alias("customers"), F.max("rank").alias("last_rank"), F.count("before").alias("rated_before")
    )


@query
def hybrid_recommend(star: StarCatalogue) -> DataFrame:
    items = star.star("embeddings")
    scores = items.where(F.col("label") > 0).select("vec_id", (F.col("label") / 10).alias("cf_score"))
    content = recommender.similarity_to(items, "vec_id", "embedding", 0)
    best = recommender.blend(content, scores, "vec_id")
    return best.select("vec_id", settled(F.col("similarity")).alias("similarity"), "cf_score", "score")


@query
def title_recommendations(star: StarCatalogue) -> DataFrame:
    return recommender.TitleRecommender().fit(star.titles, star.ratings).recommend("1")


@query
def title_recommendations_by_rating(star: StarCatalogue) -> DataFrame:
    """Without any weight on genres, the best rated titles come first."""
    best = recommender.TitleRecommender().fit(star.titles, star.ratings).recommend("1", alpha=0.0)
    return best.select("tconst", "primaryTitle", "cf_score")
