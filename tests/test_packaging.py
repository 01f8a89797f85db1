"""Queries that run Python kernels on executors must not need the package on
the workers' path: run them from another working directory."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_kernels_run_without_package_on_worker_path(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        import __spark_entry__ as E
        q = E.queries()
        print("RESULT", q["hash_tf"](spark, "/root/testdata/sf0.001").count(),
              q["embeddings_kmeans_cost"](spark, "/root/testdata/sf0.001").count(), flush=True)
        spark.stop()
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.startswith("RESULT")]
    assert lines and lines[0].split()[1:] == ["44193", "1"], out.stderr[-2000:]


def test_cli_writes_report_and_table(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    for query, out in (("q28", "report"), ("q20", "table")):
        done = subprocess.run([sys.executable, "-m", "quarry", query, "--tables", "/root/testdata/sf0.001",
                               "--output", str(tmp_path / out), "--local", "2"],
                              cwd=REPO, env=env, capture_output=True, text=True, timeout=600)
        assert done.returncode == 0, done.stderr[-2000:]
    text = "".join(p.read_text() for p in sorted((tmp_path / "report").glob("part-*")))
    assert "Confusion Matrix" in text and "<--Classified as" in text
    assert list((tmp_path / "table").glob("*.parquet"))
