"""Every query outside the subpackage llm runs; those with SQL agree with it."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from kelpline.plans import registry
from tests.oracle import same


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, data, name):
    if name in registry.ORACLE:
        same(spark, data, registry.QUERIES[name], registry.ORACLE[name])
    else:
        df = registry.QUERIES[name](spark, data)
        assert len(set(df.columns)) == len(df.columns)
        df.count()


def test_every_sql_has_a_query():
    assert set(registry.ORACLE) <= set(registry.QUERIES)


def test_core_does_not_need_llm(tmp_path):
    """A copy without the subpackage imports, and lists the other queries."""
    root = Path(__file__).parents[1]
    shutil.copytree(root / "kelpline", tmp_path / "kelpline", ignore=lambda d, names: {"llm", "__pycache__"} & set(names))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    walk = "import importlib, pkgutil, kelpline; [importlib.import_module(m.name) for m in pkgutil.walk_packages(kelpline.__path__, 'kelpline.')]"
    code = f"{walk}; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(registry.QUERIES)), str(len(registry.ORACLE))]
