"""The engine stands without the optional subpackage, and imports nothing of it."""

import ast
import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "tidemark").rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names] if isinstance(node, ast.Import) else []
            assert not any("llm" in n.split(".") for n in names), path


def test_entry_imports_without_the_subpackage(tmp_path):
    for name in ("tidemark", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / name).is_dir() else shutil.copy)(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "tidemark" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'trade_bars_1m' in q and set(s) <= set(q) and not any(n.startswith('op') and n[2].isdigit() for n in q); print(len(q))"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert run.returncode == 0, run.stderr
