"""Driver contract, and every registered query against its DuckDB oracle
on the smallest driver data set."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["segment", "customer_count", "min_spend", "avg_spend", "max_spend", "total_revenue"]
    assert df.count() >= 3
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 50


def test_oracle_agreement_sf0001():
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tools", "oracle_check.py"), "/root/testdata/sf0.001", "--core"],
        capture_output=True, text=True, timeout=1500, cwd=ROOT,
    )
    summary = [l for l in out.stdout.splitlines() if l.startswith("SUMMARY")]
    assert summary and summary[0].endswith("problems: []"), out.stdout[-3000:] + out.stderr[-2000:]


def test_runs_from_another_directory(tmp_path):
    """The package needs no particular working directory."""
    script = tmp_path / "run.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {ROOT!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as E\n"
        "print('ROWS', E.queries()['days_between_txns'](spark, '/root/testdata/sf0.001').count())\n"
    )
    out = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=600, cwd=str(tmp_path))
    assert "ROWS 6000" in out.stdout, out.stderr[-3000:]
