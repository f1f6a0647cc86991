"""Catalogue tables derived from the star-schema tables.

Each view is one expression per column over ``orders`` or ``lineitem``, so a
comma list never has to be collected from several rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.columns import NULL_MARKER
from marquee.sources.catalogue import join_path, read_columnar

# Priority to title type, return flag to credit category.
TITLE_TYPES = {
    "1-URGENT": "movie",
    "2-HIGH": "tvSeries",
    "3-MEDIUM": "short",
    "4-NOT SPECIFIED": "tvEpisode",
    "5-LOW": "video",
}
CATEGORIES = {"A": "director", "N": "writer", "R": "producer"}

# A title has a genre where this number has this rest, as SQL text.
GENRES = {
    "Action": "o_orderkey % 3 = 0",
    "Comedy": "o_custkey % 4 = 1",
    "Crime": "o_orderkey % 7 = 2",
    "Drama": "o_custkey % 2 = 0",
    "Family": "(o_orderkey + o_custkey) % 9 = 4",
    "Horror": "o_orderkey % 11 = 5",
    "Mystery": "o_custkey % 13 = 6",
    "Romance": "(o_orderkey + o_custkey) % 5 = 3",
}


def case_of(column: str, values: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{value}' THEN '{name}'" for value, name in values.items())
    return f"CASE {column} {arms} END"


def comma_list(parts: dict[str, str]) -> str:
    """SQL for the comma list of the parts whose condition holds, null if none does."""
    arms = ", ".join(f"CASE WHEN {condition} THEN {part} END" for part, condition in parts.items())
    return f"nullif(concat_ws(',', {arms}), '')"


GENRE_LIST = comma_list({f"'{name}'": condition for name, condition in GENRES.items()})


class StarCatalogue:
    """Typed catalogue views over the tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def star(self, table: str) -> DataFrame:
        return read_columnar(self.spark, join_path(self.folder, f"{table}.parquet"))

    @cached_property
    def titles(self) -> DataFrame:
        return self.star("orders").selectExpr(
            "string(o_orderkey) AS tconst",
            "concat('Title ', o_orderkey) AS primaryTitle",
            f"{case_of('o_orderpriority', TITLE_TYPES)} AS titleType",
            "if(o_orderkey % 20 = 0, 1, 0) AS isAdult",
            "CASE WHEN o_orderkey % 17 <> 0 THEN year(o_orderdate) END AS startYear",
            "CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 29 <> 0 THEN int(floor(o_totalprice / 2500)) END"
            " AS runtimeMinutes",
            f"{GENRE_LIST} AS genres",
        )

    @cached_property
    def ratings(self) -> DataFrame:
        hundredths = F.floor(F.col("l_discount") * 100 + 0.5)
        return (
            self.star("lineitem")
            .groupBy(F.col("l_orderkey").cast("string").alias("tconst"))
            .agg(
                (F.floor(F.sum(hundredths) * 10 / F.count("*")) / F.lit(10.0)).alias("averageRating"),
                F.sum("l_quantity").try_cast("int").alias("numVotes"),
            )
        )

    @cached_property
    def crew(self) -> DataFrame:
        directors = comma_list(
            {
                "concat('nm', o_custkey)": "o_orderkey % 4 <> 3",
                "concat('nm', o_custkey + 1)": "o_orderkey % 6 = 1",
                "concat('nm', o_custkey + 0)": "o_orderkey % 20 = 2",
            }
        )
        writers = comma_list(
            {
                "concat('nm', o_custkey + 2)": "o_orderkey % 5 <> 0",
                "concat('nm', o_custkey)": "o_orderkey % 2 = 0",
            }
        )
        return self.star("orders").selectExpr(
            "string(o_orderkey) AS tconst", f"{directors} AS directors", f"{writers} AS writers"
        )

    @cached_property
    def principals(self) -> DataFrame:
        return self.star("lineitem").selectExpr(
            "string(l_orderkey) AS tconst",
            "concat('nm', l_partkey) AS nconst",
            f"{case_of('l_returnflag', CATEGORIES)} AS category",
            "if(l_linestatus = 'F', 'primary', null) AS job",
        )

    @cached_property
    def akas(self) -> DataFrame:
        # ``nation`` and ``region`` have 25 and 5 rows at every scale.
        places = self.star("nation").join(
            F.broadcast(self.star("region")), F.col("n_regionkey") == F.col("r_regionkey")
        )
        lines = self.star("lineitem").join(self.star("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        return lines.join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
            "string(l_orderkey) AS titleId",
            "CASE WHEN n_nationkey = 23 THEN 'None' WHEN n_nationkey <> 24 THEN n_name END AS region",
            "CASE WHEN l_linenumber % 5 <> 0 THEN r_name END AS language",
        )

    @cached_property
    def names(self) -> DataFrame:
        return self.star("customer").selectExpr("concat('nm', c_custkey) AS nconst", "c_name AS primaryName")

    @cached_property
    def episodes(self) -> DataFrame:
        return (
            self.star("orders")
            .where(F.col("o_orderpriority") == "4-NOT SPECIFIED")
            .selectExpr("string(o_orderkey) AS tconst", "string(o_custkey) AS parentTconst")
        )

    def raw(self, table: str) -> DataFrame:
        """The view as the text files have it: strings, nulls as markers, some bad numbers."""
        frame = getattr(self, table)
        marked = frame.select(
            *(F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARKER)).alias(c) for c in frame.columns)
        )
        if table == "titles":
            bad = F.col("tconst").cast("long") % 29 == 0
            marked = marked.withColumn("runtimeMinutes", F.when(bad, "n/a").otherwise(F.col("runtimeMinutes")))
        return marked
