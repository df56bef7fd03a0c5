"""The driver contract, with the optional queries and without them."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parents[1]


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_core_stands_alone(tmp_path):
    """Without the optional folders and the pipeline the entry still imports and has the core's queries."""
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "tessera", tmp_path / "tessera", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(q) == set(e.oracle_sql()) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin", "PYTHONPATH": str(tmp_path)}, check=True, timeout=120)
