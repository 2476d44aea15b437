"""The entry without the optional operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RUN = """
import __spark_entry__ as entry
from panelprep.session import local_session
assert not [name for name in entry.queries() if name.startswith("op") or name == "pipeline"], sorted(entry.queries())
assert set(entry.oracle_sql()) <= set(entry.queries())
spark = local_session("entry", 2, 2)
print(entry.queries()["head"](spark, entry.SMOKE_DIR).count())
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_imports_without_the_optional_part(tmp_path, pipeline):
    copy = tmp_path / "repo"
    skipped = shutil.ignore_patterns("llm", ".git", "__pycache__", "*.md", "tests", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, copy, ignore=skipped)
    assert (copy / "corpus_pipeline.py").exists() == (pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": str(copy)}
    done = subprocess.run([sys.executable, "-c", RUN], cwd=copy, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and done.stdout.split()[-1] == "25", done.stderr[-3000:]
