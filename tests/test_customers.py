from helpers import ts
from storepulse.operators import customers


def _inv(spark, rows):
    return spark.createDataFrame(rows, "invoice_id long, invoicedate timestamp, store string, territory string, customer string")


def test_total_is_not_sum_of_territories(spark):
    df = _inv(spark, [
        (1, ts(2001, 1, 1), "S", "T1", "ann"),
        (2, ts(2001, 1, 1), "S", "T2", "ann"),      # same customer, second territory
        (3, ts(2001, 1, 1), "S", None, "bob"),      # no territory: counts in the total only
        (4, ts(2001, 1, 1), "S", "BAD", "cid"),     # excluded
        (5, ts(2001, 1, 1), "S", "T1", None),       # no name: not counted
        (6, ts(2001, 1, 1), "S", "T1", "dan"),
    ])
    per = {r.territory: r.customers for r in customers.customers_by_territory(df, ("BAD",)).collect()}
    assert per == {"T1": 2, "T2": 1}
    assert customers.customers_total(df, ("BAD",)).first().customers == 3


def test_approximate_option(spark):
    df = _inv(spark, [(i, ts(2001, 1, 1), "S", "T", f"c{i % 50}") for i in range(500)])
    got = customers.customers_by_territory(df, (), approximate=True).first().customers
    assert abs(got - 50) <= 3


def test_summary_equals_the_single_counts(spark):
    rows = [("a", "T1"), ("a", "T2"), ("b", "T1"), ("b", "T1"), ("c", None), (None, "T2"), ("d", "Other"), ("e", None), ("e", "T2")]
    inv = spark.createDataFrame(rows, "customer string, territory string")
    got = {(r.territory, r.is_total): r.customers for r in customers.customers_summary(inv, ("Other",)).collect()}
    want = {(r.territory, False): r.customers for r in customers.customers_by_territory(inv, ("Other",)).collect()}
    want[None, True] = customers.customers_total(inv, ("Other",)).first().customers
    assert got == want == {("T1", False): 2, ("T2", False): 2, (None, True): 4}


def test_summary_scans_once_and_shuffles_by_name(spark):
    import re

    from storepulse.plans.session import explain_text

    inv = spark.createDataFrame([("a", "T")], "customer string, territory string")
    plan = explain_text(customers.customers_summary(inv, ()))
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 2 and "Expand" not in plan
    assert re.search(r"hashpartitioning\(customer#\d+", plan)
