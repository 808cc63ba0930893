"""Archive tasks must find the package without help from the working directory."""

import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from pyspark.sql import SparkSession

spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", entry.queries()["ingest_archives"](spark, "/root/testdata/sf0.001").count())
print("rows", entry.queries()["ingest_csv_folder"](spark, "/root/testdata/sf0.001").count())
print("rows", entry.queries()["archive_source"](spark, "/root/testdata/sf0.001").count())
"""


def test_archives_from_another_folder(tmp_path, request):
    script = tmp_path / "job.py"
    script.write_text(SCRIPT)
    repo = str(request.config.rootpath)
    done = subprocess.run(
        [sys.executable, str(script), repo], cwd=tmp_path, capture_output=True, text=True, timeout=200
    )
    counts = [line for line in done.stdout.splitlines() if line.startswith("rows")]
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(counts) == 3 and len(set(counts)) == 1 and counts[0] != "rows 0"
