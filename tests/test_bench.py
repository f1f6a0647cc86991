"""The bench as the driver calls it."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="star-schema tables are not here")
def test_bench_prints_one_line_of_json():
    settings = {"BENCH_SF_DIR": FOLDER, "BENCH_CPUS": "2", "BENCH_KEYS": "genre_consistency,format_comparison,rating_density"}
    ran = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=os.environ | settings, capture_output=True, text=True, timeout=600, check=True)
    (line,) = [text for text in ran.stdout.splitlines() if text.startswith("{")]
    found = json.loads(line)
    assert found["metric"] == "headline_queries_total" and found["unit"] == "sec" and found["sf"] == 0.001
    assert set(found["queries"]) == set(settings["BENCH_KEYS"].split(","))
    assert 0 < found["value"] < found["value_of_all"]


def test_bench_keys_are_queries():
    sys.path.insert(0, str(ROOT))
    import bench

    assert len(bench.FIRST_ROUND) == 21 and set(bench.FIRST_ROUND + bench.LATER) <= set(bench.QUERIES)
