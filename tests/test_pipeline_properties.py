"""Property: however sales are split into files and runs (reruns included), the monthly marts equal direct sums."""

from __future__ import annotations

import uuid
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from test_pipeline import HEADER, _dims, _one_percent
from tillgrid.plans import pipeline

_sale = st.tuples(
    st.sampled_from([1, 2]),  # customer
    st.sampled_from([1, 2]),  # sales person
    st.sampled_from(["2023-03-03", "2023-03-20", "2023-04-01"]),
    st.integers(min_value=1, max_value=500),  # total in cents
)


@settings(max_examples=3, deadline=None)
@given(
    sales=st.lists(_sale, min_size=1, max_size=12),
    cuts=st.lists(st.integers(min_value=0, max_value=2), min_size=12, max_size=12),
    rerun=st.booleans(),
)
def test_marts_equal_direct_sums(spark, tmp_path_factory, sales, cuts, rerun):
    base = tmp_path_factory.mktemp(f"prop-{uuid.uuid4().hex[:8]}")
    out = str(base / "out")
    # Sale i goes to file cuts[i] (three files), and file k is delivered in run k.
    files: dict[int, list[str]] = {}
    for i, (c, p, d, cents) in enumerate(sales):
        files.setdefault(cuts[i], []).append(f"{c},121,oats,{d},{p},1,1,{Decimal(cents) / 100}")
    runs = []
    for k, lines in sorted(files.items()):
        folder = base / f"run{k}"
        folder.mkdir()
        (folder / f"file{k}.csv").write_text(HEADER + "\n" + "\n".join(lines) + "\n")
        runs.append(str(folder))
    if rerun:
        runs.append(runs[0])
    for folder in runs:
        pipeline.run(spark, folder, _dims(spark), out)

    want: dict[tuple[str, int], Decimal] = {}
    for _, p, d, cents in sales:
        key = (d[:7], p)
        want[key] = want.get(key, Decimal("0")) + Decimal(cents) / 100
    team = spark.read.parquet(pipeline.output_paths(out)["sales_team_data_mart"]).collect()
    assert {(r.sales_month, r.sales_person_id): r.total_sales for r in team} == want
    for r in team:
        top = max(t for (m, _), t in want.items() if m == r.sales_month)
        expected = _one_percent(r.total_sales) if r.total_sales == top else Decimal("0")
        assert r.incentive == expected
