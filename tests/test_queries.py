import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from oracle import connect, same

from pagewright.plans import catalogue


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf_dir, con, name):
    same(catalogue.QUERIES[name](spark, sf_dir).toPandas(), con.sql(catalogue.ORACLES[name]).df())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_optional_part(tmp_path, pipeline):
    """With the folder of training-data operators gone, whether or not the pipeline is, the rest is still there."""
    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "pagewright", tmp_path / "pagewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *(p.name for p in root.glob("corpus_*.py") if pipeline)]:
        shutil.copy(root / name, tmp_path / name)
    script = "import __spark_entry__ as e; from pagewright.plans import catalogue as c; assert set(e.queries()) == set(c.QUERIES) and set(e.oracle_sql()) == set(c.ORACLES)"
    subprocess.run([sys.executable, "-c", script], cwd=tmp_path, check=True, timeout=120)
