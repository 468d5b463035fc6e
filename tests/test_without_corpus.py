"""The lending engine has to stand without its corpus part, whether or not the pipeline file is left."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.registered.QUERIES), len(e.queries()), len(e.oracle_sql()))"


@pytest.mark.parametrize("left", [[], ["corpus_pipeline.py"]])
def test_entry_without_the_corpus_part(tmp_path, left):
    copied = ["__spark_entry__.py", "registered.py", "oracle_sql.py", *left]
    for name in copied:
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path)
    shutil.copytree(f"{ROOT}/ledgerlark", tmp_path / "ledgerlark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    same, queries, sql = out.stdout.split()
    assert same == "True" and int(queries) >= 60 and int(sql) >= 60
