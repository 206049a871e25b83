"""Physical-plan checks: pruning, pushdown, join shapes, no Python in the hot path."""

import re

import pytest

from conftest import SF001
from storepulse.plans import registry
from storepulse.plans.session import explain_text
from storepulse.sources import readers, tables

BAD_NODES = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "Window ")


# Windows over bounded groups: a key's cells (the calendar bounds them), an order's group of lines.
BOUNDED_WINDOWS = {
    "sales_history", "category_history", "category_margin_history", "store_target_history", "extract_documents", "extract_sale_lines",
}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_nested_loop_cartesian_or_python(spark, name):
    plan = explain_text(registry.QUERIES[name](spark, SF001))
    for node in BAD_NODES:
        if node == "Window " and name in BOUNDED_WINDOWS:
            continue
        assert node not in plan, f"{name} plans {node.strip()}"


def test_date_window_reaches_orders_scan(spark):
    plan = explain_text(registry.category_margin(spark, SF001))
    scan = plan[plan.index("orders.parquet"):]
    pushed = re.search(r"PushedFilters: \[(.*)\]", scan).group(1)
    assert "GreaterThanOrEqual(o_orderdate,2001-04-01" in pushed
    assert "LessThanOrEqual(o_orderdate,2001-07-31T23:59:59" in pushed


def test_target_date_filter_reaches_orders_scan(spark):
    plan = explain_text(registry.category_target(spark, SF001))
    scan = plan[plan.index("orders.parquet"):]
    assert "GreaterThanOrEqual(o_orderdate,2001-04-01" in re.search(r"PushedFilters: \[(.*)\]", scan).group(1)


def test_one_aggregation_serves_all_windows(spark):
    plan = explain_text(registry.category_achieved(spark, SF001))
    nodes = re.findall(r"^\(\d+\) (\w+)", plan, re.M)
    assert nodes.count("HashAggregate") == 2          # partial + final around one shuffle
    assert "Generate" in nodes and "Expand" not in nodes


def test_nested_read_schema_prunes_product_leaves(spark, tmp_out):
    inv = tables.invoices(spark, SF001)
    inv.write.mode("overwrite").parquet(f"{tmp_out}/inv")
    landed = spark.read.parquet(f"{tmp_out}/inv")
    plan = explain_text(readers.sale_lines_frame(landed).select("category", "soldqty", "sellingprice"))
    schema = re.search(r"ReadSchema: (struct<.*>)", plan).group(1)
    assert "soldqty" in schema and "sellingprice" in schema and "category" in schema
    for unused in ("manufacturer", "supplierDetails", "landingrate", "extradiscount", "customer_uid"):
        assert unused not in schema


def test_customer_count_spreads_first_shuffle_by_name(spark):
    plan = explain_text(registry.customers_by_territory(spark, SF001))
    assert re.search(r"hashpartitioning\(territory#\d+, customer#\d+", plan)


def test_weighted_age_total_is_a_scalar_subquery(spark):
    plan = explain_text(registry.lot_model_table(spark, SF001))
    assert "Subquery" in plan and "CartesianProduct" not in plan


def scans(plan):
    return set(re.findall(r"/(\w+)\.parquet", plan))


@pytest.mark.parametrize("name,needed", [
    ("expired_by_category", {"lineitem", "part", "supplier", "nation"}),
    ("expired_by_store", {"lineitem", "part", "supplier", "nation"}),
    ("expiry_grid_by_category", {"lineitem", "part"}),
    ("lot_expiry_bands", {"lineitem", "part"}),
    ("inventory_age_by_category", {"lineitem", "part", "supplier", "nation", "orders"}),
    ("lot_fiscal_year", {"lineitem", "part", "orders"}),
])
def test_only_needed_tables_are_joined(spark, name, needed):
    assert scans(explain_text(registry.QUERIES[name](spark, SF001))) == needed


def test_lines_are_counted_before_the_order_join(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = explain_text(registry.report_windows(spark, SF001), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    below = tree[tree.index("SortMergeJoin"):]
    assert "partial_count" in below and "l_orderkey" in below[: below.index("lineitem.parquet")]


def test_no_exchange_directly_above_another(spark):
    for name, fn in sorted(registry.QUERIES.items()):
        lines = [re.sub(r"^[\s:+\-*()\d]*", "", x) for x in explain_text(fn(spark, SF001), "simple").splitlines()]
        pairs = [(a, b) for a, b in zip(lines, lines[1:]) if a.startswith("Exchange") and b.startswith("Exchange")]
        assert not pairs, name


def test_building_a_query_runs_no_job(spark):
    # Every registered query is a lazy plan: constructing it launches nothing.
    sc = spark.sparkContext
    for name, fn in sorted(registry.QUERIES.items()):
        group = f"build-{name}"
        sc.setJobGroup(group, "build only")
        try:
            fn(spark, SF001)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        assert list(sc.statusTracker().getJobIdsForGroup(group)) == [], name


def test_customer_counts_read_two_nested_leaves(spark, tmp_out):
    from storepulse.operators import customers

    tables.invoices(spark, SF001).write.mode("overwrite").parquet(f"{tmp_out}/inv")
    landed = spark.read.parquet(f"{tmp_out}/inv")
    plan = explain_text(customers.customers_by_territory(readers.invoice_frame(landed), ("NATION_0",)))
    schema = re.search(r"ReadSchema: (struct<.*>)", plan).group(1)
    assert schema == "struct<customerDetails:struct<name:string>,storeDetails:struct<territory:struct<name:string>>>"
