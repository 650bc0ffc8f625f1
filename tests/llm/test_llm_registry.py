"""The registered queries: complete, equal to their SQL, and safe to leave out."""

import os
import re
import subprocess
import sys
from pathlib import Path

import pytest
from __spark_entry__ import oracle_sql, queries
from compare import TESTDATA, differences, duck

from debtlens.llm.registry import ORACLE_SQL, QUERIES

LOCATION = f"{TESTDATA}/sf0.001"
REPO = Path(__file__).resolve().parent.parent.parent


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert "pipeline" in queries() and ORACLE_SQL.keys() <= oracle_sql().keys()


@pytest.mark.skipif(not os.path.isdir(LOCATION), reason="no generated tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    assert differences(spark, duck(LOCATION), name, LOCATION) == []


def test_the_rest_imports_without_this_part(tmp_path):
    """A copy of the repository without the package, the pipeline and these tests."""
    for path in REPO.rglob("*.py"):
        part = path.relative_to(REPO)
        if "llm" in part.parts or part.name == "corpus_pipeline.py":
            continue
        target = tmp_path / part
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(path.read_bytes())
    code = "import re, __spark_entry__ as e; q = e.queries(); assert q and not any(re.match(r'op[0-9]+_|pipeline', n) for n in q)"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)
