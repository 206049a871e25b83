"""The weekly report job: every report from one pass over each input.

When all reports run together, each input is aggregated once, at the grain
of category, store and territory:

* sale lines of the reporting span: every measure by window,
* daily targets of the span by window,
* narrow lots: stock value by age and expiry bucket, and of expired lots,

and every keyed report, total, grid and scorecard is a roll-up of those
aggregates. Invoice rows feed the two customer counts. The enriched BI lot
table is written once and its roll-ups read it back.

Staging writes the aggregates as parquet under the staging folder
(``--staging``, or the cluster's ``spark.checkpoint.dir``; one of them is
required and must be shared by all executors) and reads them back. That cuts the
lineage durably: a lost executor costs a re-read, not a re-run of the joins.
Each run stages under its own ``staged/<run id>/``; a run publishes into a
folder of its own and its manifest last, so a failed run can simply be run
again. Staged folders can be expired by the folder's retention policy.

Run from the command line, from the tables or from landed extracts::

    python -m storepulse.plans.weekly --tables /path/to/tables --out /path/to/reports \\
        --as-of 2001-08-01T12:00:00 --exclude NATION_0,NATION_6
    python -m storepulse.plans.weekly --sales sales.json --targets targets.json --lots lots.json \\
        --lots-wide lots_wide.json --out /path/to/reports --as-of 2024-08-01
"""

from __future__ import annotations

import argparse
import datetime as dt
import uuid
from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.constants import EXCLUDED_TERRITORIES
from ..functions.dates import as_utc, reporting_windows, window_span
from ..operators import customers, inventory, lot_model, sales
from ..sinks.writers import new_run, publish, write_report
from ..sources import readers, rejects, tables
from .session import build_session, stage


@dataclass
class Inputs:
    """Flat inputs of the weekly job (see ``sources.schemas`` for columns).

    ``lot_totals`` optionally carries the same lots as ``lots_wide`` with
    only ``lot_model.TOTAL_COLUMNS``, so the stock-value total skips joins.
    """

    lines: DataFrame
    targets: DataFrame
    invoices: DataFrame
    lots: DataFrame
    lots_wide: DataFrame
    lot_totals: DataFrame | None = None


@dataclass
class WeeklyConfig:
    as_of: dt.datetime
    end_policy: str = "main"
    excluded: Sequence[str] = field(default_factory=lambda: list(EXCLUDED_TERRITORIES))
    fiscal_years: tuple[int, int] = lot_model.FISCAL_YEARS


def inputs_from_tables(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        lines=tables.sale_lines(spark, sf_dir),
        targets=tables.targets(spark, sf_dir).select("Store", "TM", "Category", "Date", "Daily_Target"),
        invoices=tables.invoice_rows(spark, sf_dir),
        lots=tables.lots(spark, sf_dir),
        lots_wide=tables.lots_wide(spark, sf_dir),
        lot_totals=tables.lots_wide(spark, sf_dir, lot_model.TOTAL_COLUMNS),
    )


def inputs_from_extracts(
    spark: SparkSession,
    sales: str,
    targets: str,
    lots: str,
    lots_wide: str,
    fmt: str = "json",
    multiline: bool = False,
    results: dict[str, str] | None = None,
    invoices: DataFrame | None = None,
    landing: str | None = None,
    most_rejects: float = 0.01,
) -> Inputs:
    """Inputs from the landed extracts.

    With ``landing`` each extract is first written there once, rejects apart
    (:mod:`..sources.rejects`): a record without its key or date, or with a date that can't be read, is left
    out and counted, up to ``most_rejects`` of an extract. Without it such a record stops the job.

    ``results`` names the list inside the response envelope, by extract
    (``sales``, ``targets``, ``lots``, ``lots_wide``), for those that come in one.
    An extract without any record is an error. A large sales extract is best
    landed as parquet first (``sinks.landing``), where reports read only the leaves they need.
    """
    named = results or {}
    read = {
        "sales": (readers.read_sales, sales),
        "targets": (readers.read_targets, targets),
        "lots": (readers.read_lots, lots),
        "lots_wide": (readers.read_lots_wide, lots_wide),
    }
    frames = {n: reader(spark, path, fmt, multiline, named.get(n), whole=landing is None) for n, (reader, path) in read.items()}
    if landing is not None:
        run = f"{landing.rstrip('/')}/{uuid.uuid4().hex[:12]}"
        frames = {n: rejects.land(df, readers.reject_rules(n), f"{run}/{n}", n, most_rejects).records for n, df in frames.items()}
    for name, df in frames.items():
        if df.isEmpty():
            raise readers.ExtractError(f"the {name} extract holds no record")
    return Inputs(
        lines=readers.sale_lines_frame(frames["sales"]),
        targets=readers.targets_frame(frames["targets"]),
        invoices=readers.invoice_frame(frames["sales"]) if invoices is None else invoices,
        lots=readers.lots_frame(frames["lots"]),
        lots_wide=readers.lots_wide_frame(frames["lots_wide"]),
    )


def stage_inputs(inputs: Inputs, cfg: WeeklyConfig, run_id: str | None = None) -> Inputs:
    """Aggregate lines, targets and lots once each and stage the aggregates; the rest stays as it is."""
    run = run_id or uuid.uuid4().hex[:12]
    windows = reporting_windows(cfg.as_of, cfg.end_policy)
    return Inputs(
        lines=stage(sales.line_cube(inputs.lines, windows), f"{run}/lines"),
        targets=stage(sales.target_cube(inputs.targets, windows), f"{run}/targets"),
        invoices=inputs.invoices,
        lots=stage(inventory.lot_cube(inputs.lots, cfg.as_of), f"{run}/lots"),
        lots_wide=inputs.lots_wide,
        lot_totals=inputs.lot_totals,
    )


def model_table(inputs: Inputs, cfg: WeeklyConfig) -> DataFrame:
    return lot_model.lot_model(inputs.lots_wide, cfg.as_of, inputs.lot_totals, cfg.fiscal_years)


def sales_and_stock_reports(inputs: Inputs, cfg: WeeklyConfig) -> dict[str, DataFrame]:
    """Every report over lines, targets, invoices and narrow lots."""
    w = reporting_windows(cfg.as_of, cfg.end_policy)
    ex = list(cfg.excluded)
    lines, tgt, lots = inputs.lines, inputs.targets, inputs.lots
    reports: dict[str, Callable[[], DataFrame]] = {
        "sales_summary": lambda: sales.sales_summary(lines, tgt, w),
        "category_margin": lambda: sales.margin_by(lines, w, "category", ex),
        "category_margin_running": lambda: sales.margin_by(lines, w, "category", ex, running=True),
        "category_achieved": lambda: sales.achieved_by(lines, w, "category", ex),
        "category_target": lambda: sales.target_by(tgt, w, "category", ex),
        "store_achieved": lambda: sales.achieved_by(lines, w, "store", ex),
        "store_margin_fy": lambda: sales.store_margin_fy(lines, w, ex),
        "store_target": lambda: sales.target_by(tgt, w, "store"),
        "territory_margin": lambda: sales.margin_by(lines, w, "territory", ex),
        "territory_achieved": lambda: sales.achieved_by(lines, w, "territory", ex),
        "territory_target": lambda: sales.target_by(tgt, w, "territory"),
        "scorecard_category": lambda: sales.scorecard(lines, tgt, w, "category", ex),
        "scorecard_store": lambda: sales.scorecard(lines, tgt, w, "store", ex),
        "scorecard_territory": lambda: sales.scorecard(lines, tgt, w, "territory", ex),
        "inventory_age_by_category": lambda: inventory.inventory_age_grid(lots, cfg.as_of, "category", ex),
        "inventory_age_by_territory": lambda: inventory.inventory_age_grid(lots, cfg.as_of, "territory", ex),
        "inventory_age_grid_wide": lambda: inventory.inventory_age_grid(lots, cfg.as_of, "category", ex, wide=True),
        "expired_by_category": lambda: inventory.expired_value(lots, cfg.as_of, "category", ex),
        "expired_by_store": lambda: inventory.expired_value(lots, cfg.as_of, "store", ex),
        "expiry_grid_by_category": lambda: inventory.expiry_grid(lots, cfg.as_of, "category"),
        "customers_by_territory": lambda: customers.customers_by_territory(inputs.invoices, ex),
        "customers_total": lambda: customers.customers_total(inputs.invoices, ex),
    }
    return {name: make() for name, make in reports.items()}


def model_reports(model: DataFrame) -> dict[str, DataFrame]:
    """Roll-ups of the (published or staged) BI lot table."""
    return {
        "lot_expiry_bands": lot_model.expiry_bands(model),
        "lot_weighted_age": lot_model.weighted_age(model),
        "lot_fiscal_year": lot_model.fiscal_year_summary(model),
    }


def weekly_reports(inputs: Inputs, cfg: WeeklyConfig) -> dict[str, DataFrame]:
    """Every report as a lazy frame over ``inputs`` (staged or not)."""
    model = model_table(inputs, cfg)
    return {**sales_and_stock_reports(inputs, cfg), "lot_model": model, **model_reports(model)}


def run_weekly(
    spark: SparkSession,
    inputs: Inputs,
    cfg: WeeklyConfig,
    out_root: str | None = None,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Aggregate each input once, build every report, publish the batch if ``out_root`` is given.

    The BI lot table is written once (published, or staged when nothing is
    published) and its roll-ups read that written table back, so the wide
    per-lot projection runs once and each roll-up reads a few columns.
    """
    staged = stage_inputs(inputs, cfg)
    model = model_table(staged, cfg)
    run, written = new_run(), {}
    if out_root and fmt == "parquet":
        written["lot_model"] = write_report(model, f"{out_root.rstrip('/')}/runs/{run}/lot_model", fmt, files=None)
        model = spark.read.parquet(written["lot_model"])
    else:
        model = stage(model, f"model-{uuid.uuid4().hex[:12]}")
        if out_root:
            written["lot_model"] = write_report(model, f"{out_root.rstrip('/')}/runs/{run}/lot_model", fmt, files=None)
    reports = {**sales_and_stock_reports(staged, cfg), **model_reports(model)}
    if out_root:
        publish(reports, out_root, fmt, run_id=run, written=written)
    return {**reports, "lot_model": model}


def main(argv: Sequence[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="Run the weekly retail KPI reports.")
    ap.add_argument("--tables", help="folder with the star-schema parquet tables")
    for name in ("sales", "targets", "lots", "lots-wide"):
        ap.add_argument(f"--{name}", help=f"landed {name} extract (instead of --tables, all four)")
    ap.add_argument("--extract-format", default="json", choices=["json", "parquet"])
    ap.add_argument("--results", default="", help="envelope list names, e.g. sales=invoices,lots=lots")
    ap.add_argument("--staging", help="staging folder that all executors share (default: spark.checkpoint.dir)")
    ap.add_argument("--out", required=True, help="folder for the published reports")
    ap.add_argument("--as-of", required=True, help="report clock, ISO 8601 (UTC when no offset)")
    ap.add_argument("--end-policy", default="main", choices=["main", "monday", "full_week"])
    ap.add_argument("--exclude", default=",".join(EXCLUDED_TERRITORIES), help="comma-separated territories")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    args = ap.parse_args(argv)
    extracts = [args.sales, args.targets, args.lots, args.lots_wide]
    if bool(args.tables) == any(extracts) or (any(extracts) and not all(extracts)):
        ap.error("give --tables, or all of --sales, --targets, --lots and --lots-wide")
    spark = build_session()
    if args.staging:
        spark.sparkContext.setCheckpointDir(args.staging)
    cfg = WeeklyConfig(as_of_utc(args.as_of), args.end_policy, [x for x in args.exclude.split(",") if x])
    if args.tables:
        inputs = inputs_from_tables(spark, args.tables)
    else:
        results = dict(x.split("=", 1) for x in args.results.split(",") if x)
        inputs = inputs_from_extracts(spark, *extracts, fmt=args.extract_format, results=results)
    run_weekly(spark, inputs, cfg, args.out, args.format)
    spark.stop()
    return 0


def as_of_utc(text: str) -> dt.datetime:
    return as_utc(text)


if __name__ == "__main__":
    raise SystemExit(main())
