"""The contract without the optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as contract

ROOT = Path(__file__).resolve().parents[1]


def test_the_corpus_parts_may_be_absent(tmp_path):
    left_out = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "spark-warehouse")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=left_out)
    assert not (tmp_path / "repo" / "rosterlane" / "llm").exists()
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, check=True)
    queries, oracle = (line.split() for line in done.stdout.splitlines())
    assert queries == oracle == sorted(contract.QUERIES)
