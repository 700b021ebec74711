"""The registered queries with and without the optional subpackage."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def names(folder: Path) -> set[str]:
    code = "import __spark_entry__ as e; print(*e.queries(), *e.oracle_sql())"
    env = os.environ | {"PYTHONPATH": str(folder), "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, check=True)
    return set(done.stdout.split())


def test_entry_without_the_subpackage(tmp_path):
    for path in ROOT.rglob("*.py"):
        part = path.relative_to(ROOT)
        if "llm" not in part.parts and part.name != "corpus_pipeline.py":
            (tmp_path / part).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / part).symlink_to(path)
    (tmp_path / "fleetpulse" / "llm" / "__pycache__").mkdir(parents=True)  # what git leaves of a deleted package
    left = names(tmp_path)
    assert "alerts_by_rule_severity" in left and not {n for n in left if n.startswith("op") or n == "pipeline"}
