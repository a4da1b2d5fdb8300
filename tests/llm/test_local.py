"""The operators in a process that has no settings."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

pytest.importorskip("tarnfold.llm")


def test_an_operator_needs_no_settings(tmp_path):
    code = (
        "import __spark_entry__ as e; from tarnfold.session import session; s = session('plain', '2', 2); "
        "assert s.conf.get('spark.checkpoint.dir', None) is None; "
        "print('ROWS', e.queries()['op13_filter_audit'](s, '/root/testdata/sf0.001').count())"
    )
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).parent.parent.parent)}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120, cwd=tmp_path)
    assert "ROWS 12000" in done.stdout, done.stderr[-2000:]
