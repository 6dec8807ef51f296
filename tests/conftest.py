import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakeproof.session import local_session
    folder = tempfile.mkdtemp(prefix="lakeproof-test-")
    session = local_session(8, extra={"spark.sql.warehouse.dir": f"{folder}/warehouse",
                                      "spark.checkpoint.dir": f"{folder}/checkpoints"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture(name="rows")
def rows_fixture():
    return rows
