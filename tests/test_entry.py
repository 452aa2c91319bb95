"""The entry module works without the corpus subpackage."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_without_the_corpus_subpackage(tmp_path):
    for name in ("__spark_entry__.py",):
        os.symlink(f"{ROOT}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "weftline")
    for name in os.listdir(f"{ROOT}/weftline"):
        if name != "llm":
            os.symlink(f"{ROOT}/weftline/{name}", tmp_path / "weftline" / name)
    code = "import __spark_entry__ as e; n = e.queries(); assert set(e.oracle_sql()) <= set(n); print(len(n))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    assert int(done.stdout) > 70


def test_nothing_else_imports_it():
    found = subprocess.run(
        ["grep", "-rlE", r"weftline\.llm|from weftline import llm|corpus_pipeline", "--include=*.py", f"{ROOT}/weftline", f"{ROOT}/tests"],
        capture_output=True, text=True,
    ).stdout.split()
    assert all("/llm/" in f or f.endswith("test_entry.py") for f in found)
