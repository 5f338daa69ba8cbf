"""The repository without its training-data part."""

import ast
import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import __spark_entry__ as e
names = sorted(e.queries())
assert set(e.oracle_sql()) <= set(names) and "segment_top_k" in names, names
print([n for n in names if n.startswith("op") or n == "pipeline"])
"""


def _copy(tmp_path, *without):
    ignored = shutil.ignore_patterns(".git", "__pycache__", *without)
    return shutil.copytree(ROOT, tmp_path / "copy", ignore=ignored)


def _optional_names(folder):
    env = {**os.environ, "PYTHONPATH": str(folder)}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=folder, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return ast.literal_eval(done.stdout)


def test_entry_imports_without_the_folders(tmp_path):
    assert _optional_names(_copy(tmp_path, "llm")) == []


def test_entry_imports_without_folders_and_pipeline(tmp_path):
    assert _optional_names(_copy(tmp_path, "llm", "corpus_pipeline.py")) == []


def test_a_broken_import_of_the_part_leaves_the_rest(tmp_path):
    folder = _copy(tmp_path, "tests")
    if not (folder / "dialstat" / "llm").is_dir():
        (folder / "dialstat" / "llm").mkdir()
    (folder / "dialstat" / "llm" / "__init__.py").write_text("import a_wheel_that_is_not_installed\n")
    assert _optional_names(folder) == []


def test_nothing_else_imports_the_part():
    for path in (ROOT / "dialstat").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "dialstat.llm" not in path.read_text(), path
