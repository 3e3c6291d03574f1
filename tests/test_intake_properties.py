"""Property: the typed fact does not depend on the column order of a file or on its extra columns."""

from __future__ import annotations

import datetime as dt
import uuid
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from tillgrid.plans.intake import run_intake
from tillgrid.schemas import MANDATORY_COLUMNS

ROW = {
    "customer_id": "7",
    "store_id": "121",
    "product_name": "rice, basmati",
    "sales_date": "2023-05-05",
    "sales_person_id": "3",
    "price": "9.95",
    "quantity": "2",
    "total_cost": "19.90",
}
EXPECTED = (7, 121, "rice, basmati", dt.date(2023, 5, 5), 3, Decimal("9.95"), 2, Decimal("19.90"))


def _cell(v: str) -> str:
    return f'"{v}"' if "," in v else v


@settings(max_examples=6, deadline=None)
@given(
    order=st.permutations(list(MANDATORY_COLUMNS)),
    extras=st.lists(st.sampled_from(["payment_mode", "note", "channel"]), unique=True, max_size=2),
    where=st.lists(st.integers(min_value=0, max_value=10), min_size=2, max_size=2),
)
def test_fact_independent_of_column_order(spark, tmp_path_factory, order, extras, where):
    header = list(order)
    for name, pos in zip(extras, where):
        header.insert(pos % (len(header) + 1), name)
    values = {**ROW, **{e: f"v_{e}" for e in extras}}
    root = tmp_path_factory.mktemp(f"perm-{uuid.uuid4().hex[:8]}")
    (root / "f.csv").write_text(",".join(header) + "\n" + ",".join(_cell(values[c]) for c in header) + "\n")

    fact = run_intake(spark, str(root)).fact.collect()
    assert len(fact) == 1
    r = fact[0]
    assert tuple(r[c] for c in MANDATORY_COLUMNS) == EXPECTED
    want_extra = ",".join(f"v_{e}" for e in header if e in extras) or None
    assert r.additional_column == want_extra
    assert list(r._bad_columns) == []
