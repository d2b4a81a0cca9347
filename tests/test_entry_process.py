"""The driver's view: a fresh process outside the repository loads the entry
module by path, on a plain session, and runs a query whose work happens in
Python workers (the stateful stream step)."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(f"""
    import importlib.util
    spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(ROOT, "__spark_entry__.py")!r})
    E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    assert E.entry(s).count() > 0
    n = E.queries()["stream_pct_change"](s, "/root/testdata/sf0.001").count()
    print("ROWS", n)
    s.stop()
""")


def test_fresh_process_outside_repo(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    rows = [line for line in out.stdout.splitlines() if line.startswith("ROWS")]
    assert rows and int(rows[0].split()[1]) > 0
