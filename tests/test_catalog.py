import pathlib
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from duskwork.catalog import ORACLE, QUERIES
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not pathlib.Path(FOLDER).exists():
        pytest.skip("test tables not present")
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    problem, _ = compare(QUERIES[name](spark, FOLDER), con, ORACLE[name])
    assert not problem


def test_entry(spark, con):
    assert entry.entry(spark).count() > 0


def test_other_queries_are_there_without_the_training_data_ones():
    code = (
        "import sys, warnings; sys.modules['duskwork.llm'] = None; warnings.simplefilter('ignore')\n"
        "import __spark_entry__ as e; from duskwork.catalog import QUERIES; print(set(e.queries()) == set(QUERIES) == set(e.oracle_sql()))"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=pathlib.Path(entry.__file__).parent, check=True)
    assert done.stdout.strip() == "True"
