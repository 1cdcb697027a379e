"""The driver loads __spark_entry__.py by path from its own working
directory with a plain session: every query, including those with
Arrow-batched Python stages, must run there without the package being
installed on the workers."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_and_python_stage_from_a_foreign_directory(tmp_path):
    script = textwrap.dedent(f"""
        import importlib.util
        spec = importlib.util.spec_from_file_location("spark_entry", {os.path.join(ROOT, "__spark_entry__.py")!r})
        mod = importlib.util.module_from_spec(spec); spec.loader.exec_module(mod)
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
                 .config("spark.ui.enabled", "false").getOrCreate())
        assert len(mod.entry(spark).collect()) > 0
        rows = mod.queries()["knn_accuracy"](spark, "/root/testdata/sf0.001").collect()
        assert len(rows) == 1 and rows[0]["n"] > 0
        print("OK")
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0 and "OK" in out.stdout, out.stderr[-3000:]
