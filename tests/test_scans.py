"""How often a source is read, by Spark's event log of a session of its own."""

from __future__ import annotations

import json
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
spark = (
    SparkSession.builder.master("local[4]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.checkpoint.dir", {tmp!r} + "/shared")
    .config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.dir", "file://" + {tmp!r})
    .config("spark.eventLog.compress", "false")
    .config("spark.eventLog.rolling.enabled", "false")
    .config("spark.sql.maxMetadataStringLength", "2000")
    .config("spark.sql.debug.maxToStringFields", "200")
    .getOrCreate()
)
from farelane.sources.derived import trips
df = trips(spark, {tmp!r} + "/source")
{body}
spark.stop()
"""

CASES = {
    # The two quantiles take two passes; the third is the result's own.
    "explore_clean": ("from farelane.plans.explore import explore_clean\nexplore_clean(df).count()", 3),
    # A bracket of more rows than are listed: sketch, then the table of the bracket.
    "quantile_with_many_values": (
        "from farelane.operators import quantiles as q\nq.FEW = 5\nq.CELLS = 4\n"
        "q.exact_quantile(df.withColumn('x', F.rand(1)), 'x', 0.37)",
        2,
    ),
    "quantile_with_few_values": ("from farelane.operators import quantiles as q\nq.exact_quantile(df, 'fare_amount', 0.5)", 2),
    # Two invalid rates, the histogram before the last cut and its bounds, and the explored table.
    "explore_report": (
        "from farelane.plans.explore import explore_report\n"
        "for table in explore_report(df).values():\n    table.count()",
        7,
    ),
}


def events_of(body: str, tmp: Path) -> list[dict]:
    (tmp / "shared").mkdir()
    (tmp / "source").mkdir()
    (tmp / "source" / "events.parquet").symlink_to("/root/testdata/sf0.001/events.parquet")
    code = SCRIPT.format(root=str(ROOT), tmp=str(tmp), body=body)
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=300)
    [log] = [f for f in tmp.iterdir() if f.is_file()]
    return [json.loads(line) for line in log.read_text().splitlines()]


def plans(events: list[dict]) -> list[str]:
    started = [e for e in events if e["Event"].endswith("SparkListenerSQLExecutionStart")]
    return [e["physicalPlanDescription"] for e in started]


@pytest.mark.parametrize("name", CASES)
def test_source_is_read_so_often(name, tmp_path):
    body, most = CASES[name]
    texts = plans(events_of(body, tmp_path))
    locations = [line for text in texts for line in text.splitlines() if line.startswith("Location")]
    read = sum("source/events.parquet" in line for line in locations)
    assert 0 < read <= most


def test_one_sweep_for_all_widths(tmp_path):
    """Both demand columns come from one table of slices."""
    body = CASES["explore_report"][0]
    texts = plans(events_of(body, tmp_path))
    # The tables of demand levels are cut into slices too, by level and not by time.
    cut = [text for text in texts if "REPARTITION_BY_NUM" in text]
    assert sum("bucket_" in text for text in cut) == 1 < len(cut)
