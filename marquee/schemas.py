"""The seven catalogue tables: where they lie and what their columns mean."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Table:
    """One catalogue table.

    ``types`` names only the columns whose text has to become a number; every
    other column stays text.  ``order`` is the column list used wherever rows
    need a reproducible order.
    """

    name: str
    dataset: str
    order: tuple[str, ...]
    types: dict[str, str] = field(default_factory=dict)

    @property
    def required(self) -> tuple[str, ...]:
        """Columns that a file must have, whatever their place."""
        return tuple(dict.fromkeys((*self.order, *self.types)))

    @property
    def parquet_dir(self) -> str:
        return self.dataset.replace(".", "_") + "_parquet"

    @property
    def text_file(self) -> str:
        return self.dataset + ".tsv.gz"


# Dataset names and numeric columns of the public file format.
TABLES = {
    table.name: table
    for table in (
        Table(
            "titles",
            "title.basics",
            ("tconst",),
            {"isAdult": "int", "startYear": "int", "runtimeMinutes": "int"},
        ),
        Table("ratings", "title.ratings", ("tconst",), {"averageRating": "double", "numVotes": "int"}),
        Table("names", "name.basics", ("nconst",)),
        Table("akas", "title.akas", ("titleId", "region", "language")),
        Table("episodes", "title.episode", ("tconst",)),
        Table("principals", "title.principals", ("tconst", "nconst", "category", "job")),
        Table("crew", "title.crew", ("tconst",)),
    )
}

RELEVANT_TYPES = ("movie", "tvSeries")
