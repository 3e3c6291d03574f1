"""Star join and marts on the hand-computed worked example, plus the rules of the incentive and the two total forms."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tillgrid.operators import marts
from tillgrid.operators.enrich import ENRICHED_COLUMNS, star_join
from tillgrid.schemas import CUSTOMER, SALES_FACT, SALES_TEAM, STORE

D = Decimal


def _fact(spark, items):
    data = [
        (c, s, "p", dt.date.fromisoformat(d), p, D("1.00"), 1, D(t), None)
        for c, s, d, p, t in items
    ]
    return spark.createDataFrame(data, SALES_FACT)


@pytest.fixture(scope="module")
def dims(spark):
    customer = spark.createDataFrame(
        [
            (1, "Mira", "Oakes", "3 Harbour Row", "70-01", "555-0101", None),
            (2, "Tomas", "Lind", "3 Harbour Row", "70-01", "555-0102", None),
        ],
        CUSTOMER,
    )
    store = spark.createDataFrame(
        [(121, "Mill Lane", "70-02", "Edda", None, "busy"), (122, "Quay", "70-03", "Jonas", None, "small")],
        STORE,
    )
    team = spark.createDataFrame(
        [
            (1, "Ines", "Marsh", 10, "N", "Mill Lane", "70-02", None),
            (2, "Otto", "Brandt", 10, "N", "Mill Lane", "70-02", None),
            (3, "Vera", "Holm", 10, "N", "Mill Lane", "70-02", None),
            (4, "Lars", "Ekdal", 10, "N", "Quay", "70-03", None),
        ],
        SALES_TEAM,
    )
    return customer, store, team


@pytest.fixture(scope="module")
def enriched(spark, dims):
    fact = _fact(
        spark,
        [
            (1, 121, "2023-03-03", 1, "100.00"),
            (1, 121, "2023-03-20", 1, "3.00"),
            (2, 121, "2023-03-05", 2, "103.00"),
            (2, 121, "2023-03-06", 3, "50.00"),
            (1, 122, "2023-04-01", 4, "10.00"),
            (99, 121, "2023-03-07", 1, "500.00"),  # unknown customer: dropped by the inner join
        ],
    )
    return star_join(fact, *dims)


def test_star_join_drops_unknown_keys_and_has_unique_names(enriched):
    assert enriched.columns == list(ENRICHED_COLUMNS)
    assert len(set(enriched.columns)) == len(enriched.columns)
    assert enriched.count() == 5
    assert 99 not in {r.customer_id for r in enriched.select("customer_id").collect()}


def test_star_join_drops_null_store_and_person(spark, dims):
    fact = _fact(spark, [(1, 121, "2023-03-03", 1, "1.00")]).union(
        spark.createDataFrame([(1, None, "p", dt.date(2023, 3, 3), 1, D("1"), 1, D("5"), None)], SALES_FACT)
    )
    assert star_join(fact, *dims).count() == 1


def test_customer_monthly_sales_worked_example(enriched):
    got = rows(marts.customer_monthly_sales(enriched), "customer_id", "full_name", "sales_date_month", "total_sales")
    assert got == [
        (1, "Mira Oakes", "2023-03", D("103.00")),
        (1, "Mira Oakes", "2023-04", D("10.00")),
        (2, "Tomas Lind", "2023-03", D("153.00")),
    ]


def test_sales_incentive_worked_example_with_tie(enriched):
    mart = marts.sales_incentive(enriched)
    assert mart.columns == ["store_id", "sales_person_id", "full_name", "sales_month", "total_sales", "incentive"]
    assert rows(mart) == [
        (121, 1, "Ines Marsh", "2023-03", D("103.00"), D("1.03")),
        (121, 2, "Otto Brandt", "2023-03", D("103.00"), D("1.03")),
        (121, 3, "Vera Holm", "2023-03", D("50.00"), D("0.00")),
        (122, 4, "Lars Ekdal", "2023-04", D("10.00"), D("0.10")),
    ]


def test_row_marts_columns(enriched):
    cust = marts.customer_mart_rows(enriched)
    assert cust.columns == [
        "customer_id", "first_name", "last_name", "address", "pincode", "phone_number", "sales_date", "total_cost",
    ]
    sales = marts.sales_mart_rows(enriched)
    assert sales.columns[-1] == "sales_month"
    assert {r.sales_month for r in sales.collect()} == {"2023-03", "2023-04"}


def test_mart_totals_equal_enriched_total(enriched):
    total = enriched.agg(F.sum("total_cost")).first()[0]
    assert marts.customer_monthly_sales(enriched).agg(F.sum("total_sales")).first()[0] == total
    assert marts.sales_incentive(enriched).agg(F.sum("total_sales")).first()[0] == total


def test_window_form_equals_group_form_for_unique_keys(enriched):
    assert rows(marts.customer_monthly_sales_window(enriched)) == rows(
        marts.customer_monthly_sales(enriched).select(
            "customer_id", "full_name", "address", "phone_number", "sales_date_month", "total_sales"
        )
    )


def test_window_form_gives_each_attribute_variant_the_key_total(spark, dims):
    customer, store, team = dims
    # Customer 1 appears twice with different addresses.
    twice = customer.union(
        spark.createDataFrame([(1, "Mira", "Oakes", "9 Hill Street", "70-09", "555-0101", None)], CUSTOMER)
    )
    fact = _fact(spark, [(1, 121, "2023-03-03", 1, "7.00"), (1, 121, "2023-03-04", 1, "3.00")])
    e = star_join(fact, twice, store, team)
    # The join repeats each sale once per variant; the window total over (customer, month) counts both copies.
    window = rows(marts.customer_monthly_sales_window(e), "address", "total_sales")
    assert window == [("3 Harbour Row", D("20.00")), ("9 Hill Street", D("20.00"))]
    grouped = rows(marts.customer_monthly_sales(e), "address", "total_sales")
    assert grouped == [("3 Harbour Row", D("10.00")), ("9 Hill Street", D("10.00"))]


def test_all_null_totals_all_rank_first_with_null_incentive(spark):
    monthly = spark.createDataFrame(
        [(121, 1, "a", "2023-03", None), (121, 2, "b", "2023-03", None), (122, 3, "c", "2023-03", D("4.00"))],
        "store_id long, sales_person_id long, full_name string, sales_month string, total_sales decimal(18,2)",
    )
    got = rows(marts.with_incentive(monthly), "sales_person_id", "incentive")
    assert got == [(1, None), (2, None), (3, D("0.04"))]


def test_rank_within_shares_ranks_on_ties(spark):
    df = spark.createDataFrame([("g", 5), ("g", 5), ("g", 3), ("h", 1)], "g string, v long")
    got = rows(marts.rank_within(df, ["g"], "v"), "g", "v", "rnk")
    assert got == [("g", 3, 3), ("g", 5, 1), ("g", 5, 1), ("h", 1, 1)]


_totals = st.lists(
    st.tuples(
        st.integers(min_value=1, max_value=3),
        st.one_of(st.none(), st.integers(min_value=0, max_value=500).map(lambda c: D(c) / 100)),
    ),
    min_size=1,
    max_size=25,
)


@settings(max_examples=15, deadline=None)
@given(_totals)
def test_incentive_join_form_equals_rank_form(spark, totals):
    data = [(g, i, f"p{i}", "2023-03", t) for i, (g, t) in enumerate(totals)]
    monthly = spark.createDataFrame(
        data, "store_id long, sales_person_id long, full_name string, sales_month string, total_sales decimal(18,2)"
    )
    by_max = rows(marts.with_incentive(monthly), "sales_person_id", "incentive")
    by_rank = rows(marts.incentive_by_rank(monthly), "sales_person_id", "incentive")
    assert by_max == by_rank


_groups = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),
        st.one_of(st.none(), st.integers(min_value=0, max_value=6)),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=10, deadline=None)
@given(_groups, st.integers(min_value=1, max_value=5))
def test_distributed_rank_equals_window_rank(spark, data, parts):
    from tillgrid.operators.ranking import rank_desc

    df = spark.createDataFrame([(g, v, i) for i, (g, v) in enumerate(data)], "g string, v long, i long")
    want = rows(marts.rank_within(df, ["g"], "v"), "i", "rnk")
    got = rows(rank_desc(df, ["g"], "v", num_partitions=parts), "i", "rnk")
    assert got == want


def test_star_join_without_broadcasts_gives_the_same_rows(spark, dims, enriched):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = _fact(
            spark,
            [(1, 121, "2023-03-03", 1, "100.00"), (2, 121, "2023-03-05", 2, "103.00"), (99, 121, "2023-03-07", 1, "5")],
        )
        shuffled = star_join(fact, *dims, max_broadcast_rows=0)
        assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
        hinted = star_join(fact, *dims)
        assert rows(shuffled) == rows(hinted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_window_form_keeps_sales_without_a_date(spark, dims):
    fact = _fact(spark, [(1, 121, "2023-03-03", 1, "7.00")]).union(
        spark.createDataFrame([(1, 121, "p", None, 1, D("1"), 1, D("5.00"), None)], SALES_FACT)
    )
    e = star_join(fact, *dims)
    def got(df):
        return {r.sales_date_month: r.total_sales for r in df.collect()}

    assert got(marts.customer_monthly_sales_window(e)) == got(marts.customer_monthly_sales(e)) == {
        "2023-03": D("7.00"),
        None: D("5.00"),
    }


def test_incentive_keeps_sales_without_a_date(spark, dims):
    fact = _fact(spark, [(1, 121, "2023-03-03", 1, "7.00")]).union(
        spark.createDataFrame([(2, 121, "p", None, 2, D("1"), 1, D("5.00"), None)], SALES_FACT)
    )
    mart = marts.sales_incentive(star_join(fact, *dims))
    got = {(r.sales_month, r.sales_person_id): r.incentive for r in mart.collect()}
    assert got == {("2023-03", 1): D("0.07"), (None, 2): D("0.05")}
    by_rank = marts.incentive_by_rank(marts.sales_person_monthly_sales(star_join(fact, *dims)))
    assert {(r.sales_month, r.sales_person_id): r.incentive for r in by_rank.collect()} == got


def test_distributed_rank_of_an_empty_frame(spark):
    from tillgrid.operators.ranking import rank_desc

    ranked = rank_desc(spark.createDataFrame([], "g string, v long"), ["g"], "v")
    assert ranked.columns == ["g", "v", "rnk"] and ranked.count() == 0
