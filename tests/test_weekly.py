"""The staged weekly job produces the same reports as the standalone queries."""

from pyspark.sql import functions as F

from conftest import SF001
from storepulse.plans import registry, weekly
from storepulse.plans.session import explain_text
from storepulse.sinks.writers import read_published
from storepulse.sources import readers, tables


CONFIG = weekly.WeeklyConfig(registry.FIXTURE_AS_OF, "main", list(registry.FIXTURE_EXCLUDED), registry.FIXTURE_FISCAL_YEARS)


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    return sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))


def test_weekly_job_matches_standalone_queries(spark, tmp_out):
    cfg = CONFIG
    reports = weekly.run_weekly(spark, weekly.inputs_from_tables(spark, SF001), cfg, out_root=tmp_out)
    assert set(reports) <= set(registry.QUERIES)
    for name in sorted(set(reports) - {"lot_model", "lot_weighted_age"}):
        mine = reports[name]
        ref = registry.QUERIES[name](spark, SF001)
        assert sorted(mine.columns) == sorted(ref.columns), name
        cols = sorted(ref.columns)
        assert mine.select(cols).exceptAll(ref.select(cols)).count() == 0, name
        assert ref.select(cols).exceptAll(mine.select(cols)).count() == 0, name
        published = read_published(spark, tmp_out, name)
        assert published.count() == ref.count(), name
    wa = reports["lot_weighted_age"].agg(F.sum("weighted_age_days")).first()[0]
    ref_wa = registry.QUERIES["lot_weighted_age"](spark, SF001).agg(F.sum("weighted_age_days")).first()[0]
    assert abs(wa - ref_wa) < 1e-4


def test_cli_parses_clock():
    assert weekly.as_of_utc("2001-08-01T12:00:00").isoformat() == "2001-08-01T12:00:00+00:00"


def test_one_scan_for_each_input(spark):
    inputs = weekly.inputs_from_tables(spark, SF001)
    staged = weekly.stage_inputs(inputs, CONFIG)
    for name, df in weekly.sales_and_stock_reports(staged, CONFIG).items():
        if not name.startswith("customers"):
            assert "lineitem.parquet" not in explain_text(df), name


def test_weekly_job_from_extracts(spark, tmp_out):
    import pytest

    written = {
        "sales": tables.invoices(spark, SF001),
        "targets": tables.targets(spark, SF001).select("Store", "TM", "Category", "Date", "Daily_Target"),
        "lots": tables.lot_documents(spark, SF001).filter("invoice.invoicedate LIKE '%:%'"),
        "lots_wide": tables.lot_documents_wide(spark, SF001),
    }
    for name, df in written.items():
        df.write.json(f"{tmp_out}/{name}")
    paths = [f"{tmp_out}/{n}" for n in written]
    mine = weekly.run_weekly(spark, weekly.inputs_from_extracts(spark, *paths), CONFIG, f"{tmp_out}/out")
    for name in ("sales_summary", "category_margin_running", "store_target", "scorecard_territory", "customers_total"):
        assert same(read_published(spark, f"{tmp_out}/out", name), registry.QUERIES[name](spark, SF001)), name
    assert mine["inventory_age_by_category"].count() == 24 and mine["lot_expiry_bands"].count() >= 7
    spark.createDataFrame([], "Store string, Date timestamp, Daily_Target double").write.json(f"{tmp_out}/none")
    with pytest.raises(readers.ExtractError, match="targets extract holds no record"):
        weekly.inputs_from_extracts(spark, paths[0], f"{tmp_out}/none", *paths[2:])


def test_cli_wants_tables_or_all_extracts():
    import pytest

    for argv in ([], ["--tables", "t", "--sales", "s"], ["--sales", "s"]):
        with pytest.raises(SystemExit):
            weekly.main([*argv, "--out", "o", "--as-of", "2001-08-01"])
