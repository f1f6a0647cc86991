"""SQL with the meaning of each query, for an independent engine.

Means and other fractions are rounded like the query results.  Ranks and
thresholds use values rounded to nine digits, as the analyses do.
"""

from __future__ import annotations

from marquee.schemas import TABLES
from marquee.starschema.queries import HASHING, HIGH_RATING, HIGH_TITLES, POPULARITY, STAR_KEYS
from marquee.starschema.views import CATEGORIES, GENRES, TITLE_TYPES


def _case(column: str, values: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{value}' THEN '{name}'" for value, name in values.items())
    return f"CASE {column} {arms} END"


_GENRE_ARMS = ", ".join(f"CASE WHEN {condition} THEN '{name}' END" for name, condition in GENRES.items())

VIEWS = {
    "titles": f"""
        SELECT cast(o_orderkey AS varchar) AS tconst,
               'Title ' || cast(o_orderkey AS varchar) AS "primaryTitle",
               {_case("o_orderpriority", TITLE_TYPES)} AS "titleType",
               CASE WHEN o_orderkey % 20 = 0 THEN 1 ELSE 0 END AS "isAdult",
               CASE WHEN o_orderkey % 17 <> 0 THEN cast(year(o_orderdate) AS integer) END AS "startYear",
               CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 29 <> 0
                    THEN cast(floor(o_totalprice / 2500e0) AS integer) END AS "runtimeMinutes",
               nullif(concat_ws(',', {_GENRE_ARMS}), '') AS genres
        FROM orders""",
    "ratings": """
        SELECT cast(l_orderkey AS varchar) AS tconst,
               floor(10e0 * sum(floor(100e0 * l_discount + 0.5e0)) / count(*)) / 10e0 AS "averageRating",
               try_cast(sum(l_quantity) AS integer) AS "numVotes"
        FROM lineitem GROUP BY l_orderkey""",
    "crew": """
        SELECT cast(o_orderkey AS varchar) AS tconst,
               nullif(concat_ws(',',
                   CASE WHEN o_orderkey % 4 <> 3 THEN 'nm' || o_custkey END,
                   CASE WHEN o_orderkey % 6 = 1 THEN 'nm' || (o_custkey + 1) END,
                   CASE WHEN o_orderkey % 20 = 2 THEN 'nm' || o_custkey END), '') AS directors,
               nullif(concat_ws(',',
                   CASE WHEN o_orderkey % 5 <> 0 THEN 'nm' || (o_custkey + 2) END,
                   CASE WHEN o_orderkey % 2 = 0 THEN 'nm' || o_custkey END), '') AS writers
        FROM orders""",
    "principals": f"""
        SELECT cast(l_orderkey AS varchar) AS tconst, 'nm' || l_partkey AS nconst,
               {_case("l_returnflag", CATEGORIES)} AS category,
               CASE WHEN l_linestatus = 'F' THEN 'primary' END AS job
        FROM lineitem""",
    "akas": """
        SELECT cast(l_orderkey AS varchar) AS "titleId",
               CASE WHEN n_nationkey = 23 THEN 'None' WHEN n_nationkey <> 24 THEN n_name END AS region,
               CASE WHEN l_linenumber % 5 <> 0 THEN r_name END AS language
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
             JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "names": """
        SELECT 'nm' || c_custkey AS nconst, c_name AS "primaryName" FROM customer""",
    "episodes": """
        SELECT cast(o_orderkey AS varchar) AS tconst, cast(o_custkey AS varchar) AS "parentTconst"
        FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'""",
    # Shapes several analyses share.
    "relevant": """
        SELECT t.*, r."averageRating", r."numVotes" FROM titles t LEFT JOIN ratings r USING (tconst)
        WHERE t."isAdult" = 0 AND t.genres IS NOT NULL AND t."titleType" IN ('movie', 'tvSeries')""",
    "adult_free": """
        SELECT t.*, r."averageRating", r."numVotes" FROM titles t LEFT JOIN ratings r USING (tconst)
        WHERE t."isAdult" = 0""",
    "rated": """
        SELECT t.*, r."averageRating", r."numVotes" FROM titles t JOIN ratings r USING (tconst)""",
    "relevant_genres": """
        SELECT *, unnest(string_split(genres, ',')) AS genre FROM relevant""",
    "adult_free_genres": """
        SELECT *, unnest(string_split(genres, ',')) AS genre FROM adult_free WHERE genres IS NOT NULL""",
    "rated_genres": """
        SELECT *, unnest(string_split(genres, ',')) AS genre FROM rated WHERE genres IS NOT NULL""",
    "people": """
        SELECT DISTINCT 'director' AS role, tconst, unnest(string_split(directors, ',')) AS nconst FROM crew
        UNION SELECT DISTINCT 'writer', tconst, nconst FROM principals WHERE category = 'writer'""",
    "performance": """
        SELECT role, nconst, avg("averageRating") AS avg_rating, count(*) AS num_titles,
               cast(sum("numVotes") AS bigint) AS total_votes,
               avg("averageRating") * cast(sum("numVotes") AS double) AS weighted_popularity
        FROM people JOIN relevant USING (tconst) GROUP BY role, nconst""",
}


def six(value: str, name: str | None = None) -> str:
    name = name or value
    shift, digits = ("1e-6", 3) if name in POPULARITY else ("1e-9", 6)
    return f'round({value} + {shift}, {digits}) AS "{name}"'


def catalogue(select: str) -> str:
    return "WITH " + ",".join(f"{name} AS ({body})" for name, body in VIEWS.items()) + select


ORACLE: dict[str, str] = {}


def oracle(key: str, select: str) -> None:
    ORACLE[key] = catalogue(select)


MEAN = six('avg("averageRating")', "avg_rating")
SPREAD = six('stddev_samp("averageRating")', "rating_stddev")
PERFORMANCE = f"""role, nconst, {six("avg_rating")}, num_titles, total_votes, {six("weighted_popularity")}"""
RATING_COLUMNS = f"""tconst, {six('"averageRating"', "averageRating")}, "numVotes" """

ORACLE["load_parquet"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, count(*) AS num_rows, cast(sum({key}) AS bigint) AS key_sum FROM {table}"
    for table, key in STAR_KEYS.items()
)
for _key in ("read_tsv", "null_markers"):
    oracle(
        _key,
        """SELECT tconst, "primaryTitle", "titleType", "isAdult", cast("startYear" AS double) AS "startYear",
                  cast("runtimeMinutes" AS double) AS "runtimeMinutes", genres FROM titles""",
    )
oracle("ingest_tsv_to_parquet", f"SELECT {RATING_COLUMNS} FROM ratings")
oracle("typed_ratings", f"SELECT {RATING_COLUMNS} FROM ratings")

GENRE_TRENDS = f"""
    SELECT "startYear", genre, {six("avg_rating")}, title_count, total_votes, genre_rank FROM (
        SELECT *, cast(dense_rank() OVER (PARTITION BY "startYear" ORDER BY total_votes DESC) AS integer) AS genre_rank
        FROM (SELECT "startYear", genre, avg("averageRating") AS avg_rating, count(*) AS title_count,
                     cast(sum("numVotes") AS bigint) AS total_votes
              FROM rated_genres WHERE "startYear" IS NOT NULL GROUP BY "startYear", genre HAVING count(*) > 10))
    WHERE genre_rank <= 5"""
oracle("write_csv", GENRE_TRENDS)
oracle("genre_trends", GENRE_TRENDS)

# Column names of the views in their order.
COLUMNS = {
    "titles": ["tconst", "primaryTitle", "titleType", "isAdult", "startYear", "runtimeMinutes", "genres"],
    "ratings": ["tconst", "averageRating", "numVotes"],
    "names": ["nconst", "primaryName"],
    "akas": ["titleId", "region", "language"],
    "episodes": ["tconst", "parentTconst"],
    "principals": ["tconst", "nconst", "category", "job"],
    "crew": ["tconst", "directors", "writers"],
}


def _raw(table: str) -> str:
    cells = []
    for column in COLUMNS[table]:
        text = f"coalesce(cast(\"{column}\" AS varchar), chr(92) || 'N')"
        if column == "runtimeMinutes":
            text = f"CASE WHEN cast(tconst AS bigint) % 29 = 0 THEN 'n/a' ELSE {text} END"
        cells.append(f'{text} AS "{column}"')
    return f"SELECT {', '.join(cells)} FROM {table}"


def _sample(table: str) -> str:
    order = [*TABLES[table].order, *(c for c in COLUMNS[table] if c not in TABLES[table].order)]
    rows = f"(SELECT * FROM ({_raw(table)}) ORDER BY {', '.join(f'{chr(34)}{c}{chr(34)}' for c in order)} LIMIT 5)"
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {place} AS position, '{column}' AS column_name,"
        f" 'string' AS data_type, \"{column}\" AS value FROM {rows}"
        for place, column in enumerate(COLUMNS[table])
    )


oracle("table_schemas", " UNION ALL ".join(_sample(table) for table in TABLES))
oracle(
    "format_comparison",
    " UNION ALL ".join(
        f"SELECT '{TABLES[table].dataset}' AS dataset, count(*) AS tsv_count, count(*) AS parquet_count,"
        f" true AS same_rows, true AS both_stored, true AS ratio_holds, {len(TABLES)} AS datasets FROM {table}"
        for table in TABLES
    ),
)

for _key in ("load_catalogue", "ingest_all_tables"):
    oracle(
        _key,
        " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, count(*) AS num_rows, "
            + " + ".join(f'count("{column}")' for column in COLUMNS[table])
            + f" AS filled FROM {table}"
            for table in TABLES
        ),
    )

oracle(
    "clean_drop_nulls",
    """SELECT tconst, "startYear", "runtimeMinutes" FROM titles
       WHERE "startYear" IS NOT NULL AND "runtimeMinutes" IS NOT NULL""",
)
oracle(
    "clean_fill_nulls",
    """SELECT tconst, coalesce("runtimeMinutes", 0) AS "runtimeMinutes", genres FROM titles""",
)
oracle(
    "clean_fill_map",
    """SELECT tconst, coalesce("startYear", -1) AS "startYear", coalesce(genres, '') AS genres FROM titles""",
)
oracle(
    "clean_dedupe",
    f"""SELECT tconst, nconst, category, job FROM (
            SELECT *, row_number() OVER (PARTITION BY nconst, category ORDER BY tconst, job) AS place
            FROM ({_raw("principals")})) WHERE place = 1""",
)
oracle(
    "relevant_titles",
    """SELECT tconst, "titleType", genres FROM relevant""",
)
oracle(
    "nonempty_genre_list",
    """SELECT tconst, string_split(genres, ',')[1] AS first_genre, cast(len(string_split(genres, ',')) AS integer) AS size
       FROM titles WHERE genres IS NOT NULL""",
)
oracle(
    "join_titles_ratings_left",
    f"""SELECT tconst, "titleType", {six('"averageRating"', "averageRating")}, cast("numVotes" AS double) AS "numVotes"
        FROM titles LEFT JOIN ratings USING (tconst)""",
)
oracle(
    "join_titles_ratings_inner",
    f"""SELECT tconst, "titleType", {six('"averageRating"', "averageRating")}, "numVotes"
        FROM titles JOIN ratings USING (tconst)""",
)
oracle(
    "join_three_way",
    f"""SELECT tconst, {six('"averageRating"', "averageRating")}, directors, writers
        FROM titles JOIN ratings USING (tconst) JOIN crew USING (tconst)""",
)

oracle(
    "genre_distribution",
    """SELECT genre, count(*) AS "count" FROM (SELECT unnest(string_split(genres, ',')) AS genre FROM titles)
       GROUP BY genre""",
)


def _correlations(source: str, x: str, y: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS var_x, '{b}' AS var_y, {six(f'(SELECT corr({chr(34)}{a}{chr(34)}, {chr(34)}{b}{chr(34)}) FROM ({source}))', 'corr')}"
        for a in (x, y)
        for b in (x, y)
    )


oracle(
    "genre_rating_correlation",
    _correlations(
        """SELECT genre, avg("averageRating") AS avg_rating, count(*) AS genre_count FROM rated_genres GROUP BY genre""",
        "avg_rating",
        "genre_count",
    ),
)
_POPULARITY = (
    f"""SELECT genre, total_titles, {six("avg_rating")}, total_votes, {six("weighted_popularity")}, movie_count,
               tvseries_count,
               {six("total_titles / cast((SELECT count(*) FROM relevant) AS double) * 100e0", "title_percentage")},
               {six("weighted_popularity / sum(weighted_popularity) OVER ()", "popularity_score")}
        FROM (SELECT genre, count(*) AS total_titles, avg("averageRating") AS avg_rating,
                     cast(sum("numVotes") AS bigint) AS total_votes,
                     avg("averageRating") * cast(sum("numVotes") AS double) AS weighted_popularity,
                     count(*) FILTER (WHERE "titleType" = 'movie') AS movie_count,
                     count(*) FILTER (WHERE "titleType" = 'tvSeries') AS tvseries_count
              FROM relevant_genres GROUP BY genre)"""
)
oracle("genre_popularity", _POPULARITY)
oracle(
    "genre_popularity_with_crew",
    f"""SELECT p.*, directed_titles, written_titles FROM ({_POPULARITY}) p JOIN (
            SELECT genre, count(directors) AS directed_titles, count(writers) AS written_titles
            FROM relevant_genres LEFT JOIN crew USING (tconst) GROUP BY genre) USING (genre)""",
)
for _place in ("region", "language"):
    oracle(
        f"genre_popularity_by_{_place}",
        f"""SELECT {_place}, genre, count(*) AS total_titles, {MEAN}, {six('avg("numVotes")', "avg_votes")}
            FROM rated_genres JOIN akas ON tconst = "titleId"
            WHERE "isAdult" = 0 AND "titleType" IN ('movie', 'tvSeries') GROUP BY {_place}, genre""",
    )
oracle(
    "emerging_declining_genres",
    f"""SELECT genre, "startYear", total_titles, {six("avg_rating")}, {six("avg_votes")}, total_votes,
               {six("weighted_popularity")}, total_titles_year,
               {six("total_titles / cast(total_titles_year AS double) * 100e0", "title_percentage")},
               {six("popularity_change")},
               CASE WHEN stable_change > 0 THEN 'emerging' ELSE 'declining' END AS trend
        FROM (SELECT *, cast(sum(total_titles) OVER (PARTITION BY "startYear") AS bigint) AS total_titles_year,
                     weighted_popularity - lag(weighted_popularity) OVER (PARTITION BY genre ORDER BY "startYear")
                         AS popularity_change,
                     stable - lag(stable) OVER (PARTITION BY genre ORDER BY "startYear") AS stable_change
              FROM (SELECT genre, "startYear", count(*) AS total_titles, avg("averageRating") AS avg_rating,
                           avg("numVotes") AS avg_votes, cast(sum("numVotes") AS bigint) AS total_votes,
                           avg("averageRating") * cast(sum("numVotes") AS double) AS weighted_popularity,
                           round(avg("averageRating"), 9) * cast(sum("numVotes") AS double) AS stable
                    FROM relevant_genres WHERE "startYear" IS NOT NULL GROUP BY genre, "startYear"))
        WHERE stable_change <> 0""",
)
oracle(
    "top_rated_genre",
    f"SELECT genre, {MEAN}, count(*) AS num_titles FROM relevant_genres GROUP BY genre",
)
oracle(
    "genre_consistency",
    f"SELECT genre, {MEAN}, {SPREAD}, count(*) AS num_titles FROM adult_free_genres GROUP BY genre",
)
oracle(
    "audience_preferences_by_genre",
    f"""SELECT genre, {MEAN}, {SPREAD}, {six('avg("numVotes")', "avg_votes")}, count(*) AS num_titles
        FROM adult_free_genres GROUP BY genre""",
)
for _key, _order in (("consistent", "ASC"), ("inconsistent", "DESC")):
    oracle(
        f"most_{_key}_genres",
        f"""SELECT genre, {MEAN}, {SPREAD}, count(*) AS num_titles FROM adult_free_genres GROUP BY genre
            HAVING count(*) > 50 AND stddev_samp("averageRating") IS NOT NULL
            ORDER BY round(stddev_samp("averageRating"), 9) {_order}, genre LIMIT 5""",
    )

for _key in ("top_rated_title_type", "ratings_by_title_type"):
    oracle(_key, f"""SELECT "titleType", {MEAN}, count(*) AS num_titles FROM relevant GROUP BY "titleType" """)
_BEST = 'ORDER BY "averageRating" DESC NULLS LAST, tconst LIMIT 10'
oracle(
    "top_rated_overall",
    f"""SELECT tconst, "primaryTitle", {six('"averageRating"', "averageRating")}, "titleType"
        FROM (SELECT * FROM relevant {_BEST})""",
)
oracle(
    "top_rated_movies_chart",
    f"""SELECT "primaryTitle", {six('"averageRating"', "averageRating")} FROM (SELECT * FROM relevant {_BEST})""",
)
oracle(
    "rating_distribution",
    f"""SELECT {six('"averageRating"', "averageRating")}, count(*) AS num_titles FROM relevant GROUP BY "averageRating" """,
)
oracle(
    "rating_ranges",
    """SELECT CASE WHEN "averageRating" IS NULL THEN 'unrated' WHEN "averageRating" < 2 THEN '0-2'
                   WHEN "averageRating" < 4 THEN '2-4' WHEN "averageRating" < 6 THEN '4-6'
                   WHEN "averageRating" < 8 THEN '6-8' ELSE '8-10' END AS rating_range, count(*) AS num_titles
       FROM relevant GROUP BY 1""",
)
oracle(
    "rating_histogram",
    f"""SELECT bin, {six("low + bin * ((high - low) / 20)", "bin_start")},
               {six("low + (bin + 1) * ((high - low) / 20)", "bin_end")},
               (SELECT count(*) FROM relevant
                WHERE "averageRating" IS NOT NULL AND least(cast(floor(("averageRating" - low) / (high - low) * 20) AS integer), 19) = bin) AS num_titles
        FROM (SELECT min("averageRating") AS low, max("averageRating") AS high FROM relevant)
             CROSS JOIN (SELECT cast(range AS integer) AS bin FROM range(20))""",
)
oracle(
    "rating_boxplot_by_title_type",
    f"""SELECT "titleType", {six("any_value(q1)", "q1")}, {six("any_value(q2)", "median")}, {six("any_value(q3)", "q3")},
               {six('min("averageRating") FILTER (WHERE inside)', "whisker_low")},
               {six('max("averageRating") FILTER (WHERE inside)', "whisker_high")},
               count(*) AS n, count(*) FILTER (WHERE NOT inside) AS n_outliers
        FROM (SELECT *, "averageRating" BETWEEN q1 - (q3 - q1) * 1.5e0 AND q3 + (q3 - q1) * 1.5e0 AS inside
              FROM relevant JOIN (
                  SELECT "titleType", quantile_cont("averageRating", 0.25) AS q1,
                         quantile_cont("averageRating", 0.5) AS q2, quantile_cont("averageRating", 0.75) AS q3
                  FROM relevant GROUP BY "titleType") USING ("titleType")
              WHERE "averageRating" IS NOT NULL)
        GROUP BY "titleType" """,
)
oracle(
    "rating_variance_by_title_type",
    f"""SELECT "titleType", {six('var_pop("averageRating")', "rating_variance")}, {MEAN}, count(*) AS num_titles
        FROM rated WHERE "isAdult" = 0 AND "titleType" IS NOT NULL GROUP BY "titleType" """,
)

oracle(
    "runtime_rating_pairs",
    f"""SELECT "runtimeMinutes", {six('"averageRating"', "averageRating")}, "titleType" FROM rated
        WHERE "runtimeMinutes" IS NOT NULL""",
)
oracle(
    "runtime_rating_correlation",
    _correlations('SELECT * FROM rated WHERE "runtimeMinutes" IS NOT NULL', "runtimeMinutes", "averageRating"),
)
oracle(
    "runtime_perception",
    f"""SELECT CASE WHEN "runtimeMinutes" IS NULL THEN 'unknown' WHEN "runtimeMinutes" < 30 THEN '<30 min' WHEN "runtimeMinutes" <= 60 THEN '30-60 min'
                    WHEN "runtimeMinutes" <= 90 THEN '60-90 min' WHEN "runtimeMinutes" <= 120 THEN '90-120 min'
                    ELSE '>120 min' END AS runtime_bin,
               {MEAN}, {SPREAD}, {six('avg("numVotes")', "avg_votes")}, count(*) AS num_titles
        FROM adult_free GROUP BY 1""",
)
_REGIONS = """SELECT region, avg("averageRating") AS avg_rating, count(*) AS num_titles
              FROM akas JOIN ratings ON "titleId" = tconst WHERE region IS NOT NULL AND region <> 'None'
              GROUP BY region HAVING count(*) > 50"""
oracle("ratings_by_region", f"SELECT region, {six('avg_rating')}, num_titles FROM ({_REGIONS})")
oracle(
    "top_regions",
    f"""SELECT region, {six('avg_rating')}, num_titles
        FROM (SELECT * FROM ({_REGIONS}) ORDER BY round(avg_rating, 9) DESC, region LIMIT 10)""",
)
oracle(
    "content_type_trends",
    """SELECT "startYear", "titleType", count(*) AS num_titles FROM titles
       WHERE "startYear" IS NOT NULL AND "titleType" IS NOT NULL GROUP BY "startYear", "titleType" """,
)

oracle(
    "director_productivity",
    """SELECT director_id, count(*) AS "count"
       FROM (SELECT unnest(string_split(directors, ',')) AS director_id FROM crew)
       GROUP BY director_id ORDER BY 2 DESC, 1 LIMIT 10""",
)
oracle("job_distribution", """SELECT category, job, count(*) AS "count" FROM principals GROUP BY category, job""")
oracle(
    "multi_role_people",
    """SELECT nconst, count(category) AS num_roles, string_agg(DISTINCT category, ',' ORDER BY category) AS roles
       FROM principals GROUP BY nconst ORDER BY 2 DESC, 1 LIMIT 10""",
)
oracle(
    "collaboration_network",
    """SELECT d.nconst AS director_id, p.nconst AS producer_id, count(*) AS "count"
       FROM principals d JOIN principals p USING (tconst)
       WHERE d.category = 'director' AND p.category = 'producer' GROUP BY 1, 2""",
)
oracle(
    "crew_contribution",
    f"""SELECT nconst, {six("avg_title_rating")}, total_titles, tconst, "primaryTitle",
               {six('"averageRating"', "averageRating")}
        FROM (SELECT tconst, "primaryTitle", "averageRating", unnest(string_split(directors, ',')) AS nconst
              FROM rated JOIN crew USING (tconst))
        JOIN (SELECT nconst, avg("averageRating") AS avg_title_rating, count(*) AS total_titles
              FROM (SELECT "averageRating", unnest(string_split(directors, ',')) AS nconst
                    FROM rated JOIN crew USING (tconst))
              GROUP BY nconst HAVING count(*) > 3
              ORDER BY round(avg_title_rating, 9) DESC, nconst LIMIT 10) USING (nconst)""",
)
for _key in ("director_writer_performance", "crew_performance_and_ratings"):
    oracle(_key, f"SELECT * REPLACE (cast(total_votes AS double) AS total_votes) FROM (SELECT {PERFORMANCE} FROM performance)")
_HIGH = f"""SELECT * FROM performance
            WHERE round(avg_rating, 9) >= cast({HIGH_RATING} AS double) AND num_titles >= {HIGH_TITLES}"""
oracle("high_performing_crew", f"SELECT {PERFORMANCE} FROM ({_HIGH})")
oracle(
    "top_performers_chart",
    f"SELECT {PERFORMANCE} FROM ({_HIGH} ORDER BY round(avg_rating, 9) DESC, role, nconst LIMIT 10)",
)
oracle(
    "crew_correlation_chart",
    f"""SELECT {PERFORMANCE} FROM (SELECT * FROM performance
        ORDER BY round(avg_rating, 9) * total_votes DESC NULLS LAST, role, nconst LIMIT 20)""",
)
for _person in ("director", "writer"):
    oracle(
        f"{_person}_consistency",
        f"""SELECT {_person}, {MEAN}, {SPREAD}, count(*) AS num_titles
            FROM (SELECT "averageRating", unnest(string_split({_person}s, ',')) AS {_person}
                  FROM adult_free JOIN crew USING (tconst) WHERE genres IS NOT NULL)
            GROUP BY {_person}""",
    )

_INDEXED = """SELECT genres, row_number() OVER (ORDER BY count(*) DESC, genres) - 1 AS place, count(*) OVER () AS kinds
              FROM titles WHERE genres IS NOT NULL GROUP BY genres"""
oracle(
    "genre_index",
    f"""SELECT tconst, genres, {six('cast(place AS double)', "genreIndex")} FROM titles JOIN ({_INDEXED}) USING (genres)""",
)
oracle(
    "genre_one_hot",
    f"""SELECT tconst, cast(CASE WHEN place < kinds - 1 THEN place ELSE -1 END AS bigint) AS hot,
               cast(kinds - 1 AS integer) AS size
        FROM titles JOIN ({_INDEXED}) USING (genres)""",
)
_COSINE = "list_cosine_similarity(cast(a.embedding AS double[]), cast(b.embedding AS double[]))"
ORACLE["item_similarity"] = f"""
    SELECT b.vec_id, {six(_COSINE, "similarity")} FROM embeddings a JOIN embeddings b ON a.vec_id = 0 AND b.vec_id <> 0"""
ORACLE["similar_items_topk"] = f"""
    SELECT vec_id, neighbour, {six("similarity")}, cast(place AS integer) AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(similarity, 9) DESC, neighbour) AS place
          FROM (SELECT a.vec_id, b.vec_id AS neighbour, {_COSINE} AS similarity
                FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id))
    WHERE place <= 10"""
oracle(
    "als_scores",
    f"""SELECT tconst, {six('''"averageRating" * (1 - 0.1e0 / (
            SELECT sqrt(avg("averageRating" * "averageRating")) FROM rated WHERE genres IS NOT NULL))''', "cf_score")}
        FROM rated WHERE genres IS NOT NULL""",
)
ORACLE["hybrid_recommend"] = f"""
    SELECT vec_id, {six("round(similarity, 9)", "similarity")}, {six("cf_score")}, {six("score")}
    FROM (SELECT *, 0.5e0 * similarity + 0.5e0 * coalesce(cf_score, 0) AS score
          FROM (SELECT b.vec_id, {_COSINE} AS similarity, CASE WHEN b.label > 0 THEN b.label / 10e0 END AS cf_score
                FROM embeddings a JOIN embeddings b ON a.vec_id = 0 AND b.vec_id <> 0))
    ORDER BY round(score, 9) DESC, vec_id LIMIT 10"""
_SLOT = "cast('0x' || substr(md5(tconst), 1, 8) AS bigint) % 100"
oracle(
    "rating_prediction",
    f"""SELECT count(*) AS titles,
               count(*) FILTER (WHERE genres IS NULL OR genres NOT IN (
                   SELECT genres FROM rated WHERE genres IS NOT NULL AND {_SLOT} < 80)) AS unseen,
               count(*) AS scored, true AS no_worse_than_the_mean
        FROM rated WHERE {_SLOT} >= 80""",
)
oracle(
    "genre_embedding_check",
    """SELECT genres, count(*) AS titles, 100 AS length, cast(1 AS bigint) AS vectors
       FROM rated WHERE genres IS NOT NULL GROUP BY genres""",
)
ORACLE["als_factor_scores"] = """
    SELECT count(*) AS pairs, true AS not_negative, true AS better_than_the_mean
    FROM (SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
oracle(
    "title_recommendations_by_rating",
    f"""SELECT tconst, "primaryTitle", {six('''"averageRating" * (1 - 0.1e0 / (
            SELECT sqrt(avg("averageRating" * "averageRating")) FROM rated WHERE genres IS NOT NULL))''', "cf_score")}
        FROM rated WHERE genres IS NOT NULL AND tconst <> '1' AND EXISTS (
            SELECT 1 FROM rated w WHERE w.tconst = '1' AND w.genres IS NOT NULL)
        ORDER BY "averageRating" DESC, tconst LIMIT 10""",
)
oracle(
    "crew_contribution_lists",
    f"""SELECT nconst, {six("avg_title_rating")}, count(*) AS total_titles,
               string_agg("primaryTitle", '|' ORDER BY "primaryTitle") AS titles
        FROM (SELECT "primaryTitle", unnest(string_split(directors, ',')) AS nconst FROM rated JOIN crew USING (tconst))
        JOIN (SELECT nconst, avg("averageRating") AS avg_title_rating
              FROM (SELECT "averageRating", unnest(string_split(directors, ',')) AS nconst
                    FROM rated JOIN crew USING (tconst))
              GROUP BY nconst HAVING count(*) > 3
              ORDER BY round(avg("averageRating"), 9) DESC, nconst LIMIT 10) USING (nconst)
        GROUP BY nconst, avg_title_rating""",
)

_REASON = """CASE WHEN key % 97 = 0 THEN 'too few fields' WHEN key % 89 = 0 THEN 'too many fields'
                  WHEN key % 29 = 0 THEN 'runtimeMinutes: not a number' ELSE 'accepted' END"""
oracle(
    "ingest_rejects",
    f"""SELECT reason, count(*) AS num_rows, cast(sum(key) AS bigint) AS key_sum
        FROM (SELECT key, {_REASON} AS reason FROM (SELECT cast(tconst AS bigint) AS key FROM titles)) GROUP BY reason""",
)
oracle(
    "rating_density",
    f"""SELECT {six("x")}, {six("sum(n * exp(-power((x - value) / width, 2) / 2)) / any_value(rows * width * sqrt(2 * pi()))", "density")}
        FROM (SELECT low + place * (high - low) / 199 AS x, rows, width
              FROM (SELECT min("averageRating") AS low, max("averageRating") AS high, count("averageRating") AS rows,
                           stddev_samp("averageRating") * power(count("averageRating"), -0.2e0) AS width FROM relevant)
                   CROSS JOIN (SELECT range AS place FROM range(200)))
             CROSS JOIN (SELECT "averageRating" AS value, count(*) AS n FROM relevant
                         WHERE "averageRating" IS NOT NULL GROUP BY "averageRating")
        GROUP BY x""",
)
ORACLE["price_quantile_sketches"] = "SELECT l_returnflag, count(*) AS n, true AS within_error FROM lineitem GROUP BY l_returnflag"
oracle(
    "rating_boxplot_sketched",
    """SELECT "titleType", count(*) AS n, true AS in_order, true AS few_outliers
       FROM relevant WHERE "averageRating" IS NOT NULL GROUP BY "titleType" """,
)
ORACLE["embedding_correlation"] = f"""
    WITH cells AS (SELECT vec_id, cast(unnest(range(len(embedding))) AS integer) AS dim, cast(unnest(embedding) AS double) AS value FROM embeddings)
    SELECT x.dim AS dim_x, y.dim AS dim_y, {six("corr(x.value, y.value)", "corr")}
    FROM cells x JOIN cells y USING (vec_id) GROUP BY x.dim, y.dim"""
oracle(
    "genre_multi_hot",
    """SELECT tconst, string_agg(CASE WHEN list_contains(string_split(coalesce(genres, ''), ','), genre) THEN '1' ELSE '0' END, ',' ORDER BY place) AS marks
       FROM titles CROSS JOIN (
           SELECT genre, row_number() OVER (ORDER BY count(*) DESC, genre) AS place
           FROM (SELECT unnest(string_split(genres, ',')) AS genre FROM titles WHERE genres IS NOT NULL) GROUP BY genre)
       GROUP BY tconst""",
)
oracle(
    "votes_prediction",
    f"""SELECT count(*) AS titles, count(*) AS same_after_loading, cast(2 AS bigint) AS trials, true AS beats_the_mean
        FROM rated WHERE {_SLOT} >= 80""",
)
oracle(
    "votes_prediction_unseen",
    "SELECT count(*) AS titles, count(*) AS scored, true AS beats_the_mean FROM rated WHERE genres LIKE '%Drama%'",
)
_PLANES = HASHING.tables * HASHING.planes
# Planes through the mean, signatures per table, and blocks of their order, as text.
_HASHED = f"""
    WITH size AS (SELECT len(embedding) AS size FROM embeddings LIMIT 1),
    centre AS (SELECT list(value ORDER BY dim) AS centre FROM (
        SELECT dim, avg(value) AS value FROM (
            SELECT unnest(range(len(embedding))) AS dim, cast(unnest(embedding) AS double) AS value FROM embeddings) GROUP BY dim)),
    normals AS (SELECT plane, list(value - floor(value) - 0.5e0 ORDER BY dim) AS normal FROM (
        SELECT p.range AS plane, d.range AS dim, sin(p.range * 977 + d.range * 131 + 7) * 43758.5453e0 AS value
        FROM range({_PLANES}) p CROSS JOIN size, range(size) d) GROUP BY plane),
    vectors AS (SELECT vec_id, list_transform(list_zip(cast(embedding AS double[]), centre), lambda z: z[1] - z[2]) AS vector FROM embeddings, centre),
    signed AS (SELECT vec_id, plane // {HASHING.planes} AS hash_table,
        sum(CASE WHEN list_dot_product(vector, normal) > 0 THEN 1 << ({HASHING.planes} - 1 - plane % {HASHING.planes}) ELSE 0 END) AS signature
        FROM vectors, normals GROUP BY vec_id, plane // {HASHING.planes}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY hash_table ORDER BY signature, vec_id) - 1 AS place FROM signed),
    blocks AS (SELECT vec_id, hash_table, shift, (place + shift) // {HASHING.block} AS block
        FROM ranked, (VALUES (0), ({HASHING.block // 2})) s(shift)),
    met AS (SELECT a.vec_id, b.vec_id AS neighbour FROM blocks a JOIN blocks b USING (hash_table, shift, block) WHERE a.vec_id <> b.vec_id),
    scored AS (SELECT m.vec_id, m.neighbour, {_COSINE} AS similarity
        FROM (SELECT DISTINCT * FROM met) m JOIN embeddings a ON a.vec_id = m.vec_id JOIN embeddings b ON b.vec_id = m.neighbour),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(similarity, 9) DESC, neighbour) AS place FROM scored)
        WHERE place <= 10)"""
ORACLE["similar_items_lsh"] = f"""{_HASHED}
    SELECT vec_id, neighbour, {six("similarity")}, cast(place AS integer) AS rank FROM best"""
ORACLE["similar_items_lsh_recall"] = f"""{_HASHED},
    exact AS (SELECT vec_id, neighbour FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(similarity, 9) DESC, neighbour) AS place
        FROM (SELECT a.vec_id, b.vec_id AS neighbour, {_COSINE} AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id))
        WHERE place <= 10)
    SELECT count(*) AS neighbours, {six("count(f.neighbour) / cast(count(*) AS double)", "recall")}, true AS enough,
           (SELECT count(*) // 2 FROM met) AS compared, (SELECT count(*) * (count(*) - 1) // 2 FROM embeddings) AS all_pairs
    FROM exact e LEFT JOIN best f ON e.vec_id = f.vec_id AND e.neighbour = f.neighbour"""
_BOUGHT = "SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
ORACLE["als_recommendations"] = f"""
    SELECT o_custkey, parts, 1 AS first_rank, cast(parts AS integer) AS last_rank, cast(0 AS bigint) AS rated_before, true AS in_order
    FROM (SELECT o_custkey, least(10, (SELECT count(DISTINCT l_partkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) - count(*)) AS parts
          FROM ({_BOUGHT}) GROUP BY o_custkey) WHERE parts > 0"""
ORACLE["als_audience"] = f"""
    SELECT l_partkey, customers, cast(customers AS integer) AS last_rank, cast(0 AS bigint) AS rated_before
    FROM (SELECT l_partkey, least(5, (SELECT count(DISTINCT o_custkey) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) - count(*)) AS customers
          FROM ({_BOUGHT}) WHERE l_partkey % 100 = 0 GROUP BY l_partkey) WHERE customers > 0"""

_LISTED = """SELECT tconst FROM rated WHERE genres IS NOT NULL"""
oracle(
    "similar_titles_check",
    f"""SELECT tconst, least(10, (SELECT count(*) FROM ({_LISTED})) - 1) AS neighbours, true AS in_order,
               cast(0 AS bigint) AS itself, true AS alike FROM ({_LISTED})""",
)
oracle(
    "title_recommendations_check",
    f"""SELECT least(10, count(*) - 1) AS titles, cast(0 AS bigint) AS itself, true AS blended, true AS bounded FROM ({_LISTED})""",
)
