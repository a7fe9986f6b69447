"""All queries with executors that have neither the package nor the folder it lies in."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", "file://" + {shared!r}).getOrCreate())
spark.sparkContext.setLogLevel("ERROR")


def seen(rows):
    import importlib.util
    yield importlib.util.find_spec("riskspark") is not None


assert not any(spark.range(1).rdd.mapPartitions(seen).collect())
sys.path.insert(0, {root!r})  # the driver's own path: running workers do not get it
import __spark_entry__ as entry
for name, fn in sorted(entry.queries().items()):
    if name.startswith("op") or name == "pipeline":
        fn(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
        print("ran", name, flush=True)
"""


def test_workers_without_the_package(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=str(ROOT), shared=str(tmp_path / "shared")))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1200)
    ran = {line.split()[1] for line in done.stdout.splitlines() if line.startswith("ran ")}
    assert done.returncode == 0, done.stderr[-3000:]
    assert "pipeline" in ran and len(ran) >= 14
