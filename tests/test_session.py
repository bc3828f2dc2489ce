"""Cutting lineage."""

import os
import subprocess
import sys

from igarape.session import cut_lineage

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import os, sys
sys.path.insert(0, sys.argv[1])
from igarape.session import build_session, cut_lineage
spark = build_session(master="local[1]", **{"spark.checkpoint.dir": sys.argv[2], "spark.ui.enabled": "false"})
kept = cut_lineage(spark.range(5))
assert kept.count() == 5
assert kept.inputFiles()[0].startswith("file://" + sys.argv[2]), kept.inputFiles()
"""


def test_named_folder_is_used(tmp_path):
    folder = tmp_path / "shared"
    subprocess.run([sys.executable, "-c", SCRIPT, ROOT, str(folder)], check=True, timeout=180)
    assert os.path.isdir(folder)
    assert not [name for name in os.listdir(folder) if "igarape" in name]  # cleared when the application ends


def test_result_is_read_from_files(spark):
    source = spark.range(10).selectExpr("id", "cast(id as string) t", "cast(null as double) x")
    kept = cut_lineage(source)
    assert kept.schema.simpleString() == source.schema.simpleString()
    assert sorted(r.id for r in kept.collect()) == list(range(10))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Range" not in plan
    assert cut_lineage(source.filter("id < 0")).count() == 0
