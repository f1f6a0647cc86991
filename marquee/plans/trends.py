"""Questions about production over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.shaping import summarise


def content_type_trends(titles: DataFrame) -> DataFrame:
    """Titles per year and type."""
    dated = titles.where(F.col("startYear").isNotNull() & F.col("titleType").isNotNull())
    return summarise(dated, ["startYear", "titleType"], num_titles=F.count("*")).orderBy("startYear", "titleType")
