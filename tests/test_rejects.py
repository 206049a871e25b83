"""Rejected records go aside, are counted, and stop the job beyond a limit."""

import json
import os

import pytest

from conftest import SF001
from storepulse.plans import registry, weekly
from storepulse.sinks.writers import read_published
from storepulse.sources import readers, rejects, tables


def _write(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.writelines(json.dumps(r) + "\n" for r in records)
    return path


def _target(**extra):
    return {"Store": "S1", "TM": "T1", "Category": "A", "Date": "2001-07-25T00:00:00Z", "Daily_Target": 1.5} | extra


def test_null_measures_are_kept(spark, tmp_out):
    path = _write(f"{tmp_out}/t/t.json", [_target(), _target(Daily_Target=None)])
    assert sorted(str(r.Daily_Target) for r in readers.read_targets(spark, path).collect()) == ["1.5", "None"]
    lot = {"storeDetails": {"name": "S"}, "productDetails": {"category": {"name": "A"}}, "rate": None, "subqty": None}
    assert readers.read_lots(spark, _write(f"{tmp_out}/l/l.json", [lot])).count() == 1


def test_incomplete_records_go_aside_with_a_reason(spark, tmp_out):
    rows = [_target(Store=f"S{i}") for i in range(200)] + [_target(Date=None), _target(Store=None)]
    path = _write(f"{tmp_out}/t/t.json", rows)
    with pytest.raises(Exception, match="without Store or Date"):
        readers.read_targets(spark, path).collect()
    found = readers.read_targets(spark, path, whole=False)
    landed = rejects.land(found, readers.reject_rules("targets"), f"{tmp_out}/landed", "targets", most=0.02)
    assert (landed.n_records, landed.n_rejects, landed.by_reason) == (200, 2, {"no Store": 1, "no Date": 1})
    assert landed.records.count() == 200 and landed.records.columns == found.columns
    aside = {r.reject_reason: json.loads(r.record) for r in landed.rejects.collect()}
    assert aside["no Date"]["Store"] == "S1" and "Store" not in aside["no Store"]


def test_too_many_rejects_stop_the_job(spark, tmp_out):
    path = _write(f"{tmp_out}/t/t.json", [_target(), _target(Date=None)])
    with pytest.raises(rejects.TooManyRejects, match="1 of 2"):
        rejects.land(readers.read_targets(spark, path, whole=False), readers.reject_rules("targets"), f"{tmp_out}/landed", "targets")


def test_records_of_another_kind_stop_the_job(spark, tmp_out):
    path = _write(f"{tmp_out}/t/t.json", [_target(), {"errors": [{"message": "no"}]}])
    with pytest.raises(Exception, match="without any of Store, Date"):
        readers.read_targets(spark, path, whole=False).collect()


def test_unreadable_dates_are_rejected_and_all_is_accounted_for(spark):
    lots, rules = tables.faulty_lots(spark, SF001), readers.reject_rules("lots")
    n = lots.count()
    by = {r.reject_reason: r.records for r in rejects.counts(lots, rules).collect()}
    assert sum(by.values()) == n and by["unreadable invoice.invoicedate"] > 0
    assert rejects.accepted(lots, rules).count() == by[None] and rejects.rejected(lots, rules).count() == n - by[None]
    assert readers.lots_frame(rejects.accepted(lots, rules), strict=False).filter("invoicedate is not null").count() == by[None]


def test_no_records(spark, tmp_out):
    none = tables.faulty_lots(spark, SF001).filter("qty < 0")
    landed = rejects.land(none, readers.reject_rules("lots"), f"{tmp_out}/landed", "lots")
    assert (landed.n_records, landed.n_rejects) == (0, 0) and landed.records.count() == 0


def test_weekly_job_leaves_rejects_out(spark, tmp_out):
    written = {
        "sales": tables.invoices(spark, SF001),
        "targets": tables.targets(spark, SF001).select("Store", "TM", "Category", "Date", "Daily_Target"),
        "lots": tables.lot_documents(spark, SF001).filter("invoice.invoicedate LIKE '%:%'"),
        "lots_wide": tables.lot_documents_wide(spark, SF001),
    }
    for name, df in written.items():
        df.write.json(f"{tmp_out}/{name}")
    _write(f"{tmp_out}/targets/more.json", [_target(Store=None, Daily_Target=9e9)])
    paths = [f"{tmp_out}/{n}" for n in written]
    cfg = weekly.WeeklyConfig(registry.FIXTURE_AS_OF, "main", list(registry.FIXTURE_EXCLUDED))
    inputs = weekly.inputs_from_extracts(spark, *paths, landing=f"{tmp_out}/landing")
    weekly.run_weekly(spark, inputs, cfg, f"{tmp_out}/out")
    got = {(r.window_seq, r.target_lakh) for r in read_published(spark, f"{tmp_out}/out", "sales_summary").collect()}
    assert got == {(r.window_seq, r.target_lakh) for r in registry.sales_summary(spark, SF001).collect()}
