import gzip
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from fixture_tables import COLUMNS, ROWS  # noqa: E402

from marquee.schemas import TABLES  # noqa: E402
from marquee.sources.catalogue import Catalogue  # noqa: E402
from marquee.sources.ingest import ingest  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bases(spark, tmp_path_factory):
    """Folders with the small tables as gzip text and, ingested from it, as Parquet."""
    text = tmp_path_factory.mktemp("text")
    parquet = tmp_path_factory.mktemp("parquet")
    for name, rows in ROWS.items():
        lines = ["\t".join(COLUMNS[name].split()), *("\t".join(row) for row in rows)]
        with gzip.open(text / TABLES[name].text_file, "wt") as target:
            target.write("\n".join(lines) + "\n")
        ingest(spark, str(text), str(parquet), name)
    return SimpleNamespace(text=str(text), parquet=str(parquet))


@pytest.fixture(scope="session")
def small(spark, bases):
    """The small tables, read back typed."""
    catalogue = Catalogue(spark, bases.parquet, ingested=True)
    return SimpleNamespace(**{name: catalogue.table(name) for name in TABLES})


def rows(frame, *columns):
    """Rows as tuples in the order of the frame."""
    return [tuple(row) for row in (frame.select(*columns) if columns else frame).collect()]
