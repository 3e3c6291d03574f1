"""Shared fixtures: one local session for the whole run and small helpers to build frames."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from tillgrid.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=8, app="tillgrid-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_SMALL, "lineitem.parquet").exists():
        pytest.skip("driver tables not present")
    return SF_SMALL


def rows(df, *cols):
    """Rows of ``df`` as sorted tuples (of ``cols`` when given)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
