"""What is left when the training-data operators are taken out must import and answer."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import __spark_entry__ as entry
assert set(entry.queries()) == set(entry.oracle_sql()) and not any(n.startswith("op1") or n == "pipeline" for n in entry.queries())
from dayledger.session import local_session
spark = local_session("2", "without", spark__sql__shuffle__partitions="2")
print("rows", entry.queries()["kpi_invoices_day"](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_import_and_query_without_the_operators(tmp_path, pipeline):
    shutil.copytree(os.path.join(ROOT, "dayledger"), tmp_path / "dayledger", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "bench.py", *(["corpus_pipeline.py"] if pipeline else [])):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), tmp_path)
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=300,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.rpartition("rows")[2]) > 0
