"""The entry module imports with and without the optional folders."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), *sorted(e.queries()))"


def _names(folder, **env):
    out = subprocess.run(
        [sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": "", **env})
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


@pytest.mark.parametrize("gone", [("grantflow/llm", "tests/llm"), ("grantflow/llm", "tests/llm", "corpus_pipeline.py")])
def test_import_without_optional_parts(tmp_path, gone):
    def ignored(folder, names):
        here = os.path.relpath(folder, ROOT)
        return [n for n in names if n.startswith(".") or n == "__pycache__" or os.path.normpath(f"{here}/{n}") in gone]

    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=ignored)
    count, with_sql, *names = _names(copy)
    assert int(count) == int(with_sql) == len(names) > 60
    assert not [n for n in names if n.startswith("op") and n[2].isdigit() or n == "pipeline"]


def test_error_inside_an_optional_part_is_not_hidden(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    (copy / "grantflow" / "llm").mkdir()
    (copy / "grantflow" / "llm" / "__init__.py").write_text("")
    (copy / "grantflow" / "llm" / "queries.py").write_text("import no_such_library")
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=copy, capture_output=True, text=True)
    assert out.returncode != 0 and "no_such_library" in out.stderr
