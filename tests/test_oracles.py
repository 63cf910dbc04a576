"""Every workload query against its SQL."""

from __future__ import annotations

import pytest

from maskloom.workload.oracles import ORACLES
from maskloom.workload.queries import QUERIES
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def duck(shop_folder):
    connection = connect(shop_folder)
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, shop_folder, duck, name):
    assert difference(QUERIES[name](spark, shop_folder), duck, ORACLES[name]) is None


def test_the_entry_is_imported_without_a_session():
    """The driver imports before it has a session; no column may be made while a module loads."""
    import subprocess
    import sys
    from pathlib import Path

    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=Path(__file__).parent.parent, capture_output=True, text=True)
    assert done.returncode == 0 and int(done.stdout) >= len(QUERIES), done.stderr
