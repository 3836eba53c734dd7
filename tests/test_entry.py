"""The driver contract with and without the training-data package."""

import json
import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def listed(folder, code=LIST):
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0, done.stderr
    return json.loads(done.stdout)


@pytest.fixture
def copy(tmp_path):
    """The repository's core alone, in a folder of its own."""
    shutil.copytree(os.path.join(ROOT, "rankloom"), tmp_path / "rankloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    return tmp_path


def test_core_alone(copy):
    queries, sql = listed(copy)
    assert "model1_matrix" in queries and set(sql) <= set(queries) and not [q for q in queries if q.startswith("op")]


def test_a_leftover_folder_costs_nothing(copy):
    os.makedirs(copy / "rankloom" / "llm" / "__pycache__")
    assert listed(copy) == listed(copy, "import sys; sys.modules['rankloom.llm'] = None\n" + LIST)


def test_a_missing_library_costs_its_package_alone(copy):
    llm = copy / "rankloom" / "llm"
    os.makedirs(llm)
    for name in ("__init__.py", "oracle_sql.py"):
        (llm / name).write_text("SQL = {}\n")
    (llm / "queries.py").write_text("import a_library_that_is_not_there\n")
    queries, _ = listed(copy)
    assert "model1_matrix" in queries and not [q for q in queries if q.startswith("op")]
