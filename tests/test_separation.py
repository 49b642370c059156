"""The library without its optional subpackage: what stays must import and collect."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _copy(to, skip):
    shutil.copytree(ROOT, to, ignore=shutil.ignore_patterns("__pycache__", ".git", ".pytest_cache", *skip))


def _run(code, cwd):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, *code], cwd=cwd, env=env, capture_output=True, text=True, check=False)


def test_entry_without_the_subpackage_but_with_the_pipeline_file(tmp_path):
    _copy(tmp_path / "r", ["llm"])
    if os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        assert (tmp_path / "r" / "corpus_pipeline.py").exists()
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') and k[2].isdigit() for k in q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"
    out = _run(["-c", code], tmp_path / "r")
    assert out.returncode == 0, out.stderr
    n, *rest = out.stdout.split()
    assert int(n) > 50 and rest == ["False", "False", "True"]


def test_remaining_tests_collect_without_the_subpackage(tmp_path):
    _copy(tmp_path / "r", ["llm", "corpus_pipeline.py"])
    out = _run(["-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"], tmp_path / "r")
    assert out.returncode == 0, out.stdout + out.stderr
    assert "test_golden_wiki" in out.stdout and "error" not in out.stdout.lower()


def test_all_tests_collect_together(tmp_path):
    _copy(tmp_path / "r", [])
    out = _run(["-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"], tmp_path / "r")
    assert out.returncode == 0, out.stdout + out.stderr
