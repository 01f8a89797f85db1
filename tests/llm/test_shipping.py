"""Every operator runs where the package is not on the workers' path: from another working directory."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_executors_need_no_copy_of_the_package(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        from quarry.llm import queries
        for name, query in queries.QUERIES.items():
            print("RESULT", name, query(spark, "/root/testdata/sf0.001").count(), flush=True)
        spark.stop()
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    found = [line.split()[1:] for line in out.stdout.splitlines() if line.startswith("RESULT")]
    assert len(found) == 13 and all(int(n) > 0 for _, n in found), out.stderr[-3000:]
