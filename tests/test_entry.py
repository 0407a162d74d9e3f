"""The driver's entry point works without the text operators, whatever is left of them."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
import __spark_entry__ as entry
from checks.oracle import ORACLE
from checks.queries import QUERIES
assert set(entry.queries()) == set(QUERIES), set(entry.queries()) ^ set(QUERIES)
assert set(entry.oracle_sql()) == set(ORACLE)
assert not any(name.startswith("martwright.llm.") for name in sys.modules)
"""


@pytest.mark.parametrize("left", ["pipeline file", "nothing", "empty folder"])
def test_entry_without_text_operators(tmp_path, left):
    for name in ["martwright", "checks", "__spark_entry__.py", "corpus_pipeline.py"]:
        place = os.path.join(ROOT, name)
        if os.path.isdir(place):
            shutil.copytree(place, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif os.path.exists(place) and not (name == "corpus_pipeline.py" and left == "nothing"):
            shutil.copy(place, tmp_path / name)
    if left == "empty folder":
        (tmp_path / "martwright/llm").mkdir()
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert done.returncode == 0, done.stderr
