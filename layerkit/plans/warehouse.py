"""One refresh of the retail warehouse: load, cleanse, validate, model, validate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from layerkit.operators.checks import Policy, alerts, layer_checks, run_checks, tiered
from layerkit.operators.contracts import Contract, enforce
from layerkit.operators.expectations import run_checkpoint
from layerkit.operators.profile import profile_layer
from layerkit.operators.report import write_issues, write_report, write_summary
from layerkit.plans import gold, quality, silver
from layerkit.plans.schemas import BRONZE, GOLD, SILVER, SOURCE_FILES
from layerkit.session import few_rows
from layerkit.sources.catalogue import Catalogue
from layerkit.sources.csv import read_csv
from layerkit.sources.tables import create_layers, create_table, write_table

LOG_SCHEMA = "run string, pos int, step string, state string, at timestamp_ntz, message string"

ALERT_SCHEMA = "run string, step string, status string, message string"


class StepFailed(Exception):
    """A step raised; `log` holds the run log up to it, `alert` the message stored for it."""

    def __init__(self, step: str, error: Exception, log: DataFrame, alert: DataFrame):
        super().__init__(f"{step}: {error}")
        self.log, self.alert = log, alert


@dataclass
class Warehouse:
    """Where a warehouse reads its source files and keeps its tables and reports. Checks, threshold
    and issue files are those of `catalogue` if given. `contracts` are the published ones unless told
    otherwise."""

    spark: SparkSession
    source: str
    root: str
    policy: Policy | None = None
    on_invalid_date: str = "fail"
    detailed_report: bool = True
    catalogue: Catalogue | None = None
    contracts: Mapping[str, Contract] = field(default_factory=lambda: quality.PUBLISHED_CONTRACTS)
    multi_line: bool = False

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def artifacts(self, *parts: str) -> str:
        return "/".join([self.root, "artifacts", *parts])

    # --- steps, each a full refresh that can be repeated --------------------------------

    def define(self) -> None:
        create_layers(self.spark)
        for layer, layouts in (("bronze", BRONZE), ("silver", SILVER), ("gold", GOLD)):
            for name, layout in layouts.items():
                create_table(self.spark, self.root, f"{layer}.{name}", layout)

    def load_bronze(self, tables: Sequence[str] = tuple(BRONZE)) -> None:
        for name in tables:
            rows = read_csv(
                self.spark, f"{self.source}/{SOURCE_FILES[name]}", BRONZE[name], multi_line=self.multi_line
            )
            write_table(rows, self.root, f"bronze.{name}")

    def load_silver(self, tables: Sequence[str] = tuple(SILVER)) -> None:
        for name in tables:
            rows = self.table(f"bronze.{name}")
            rows = silver.sales(rows, self.on_invalid_date) if name == "crm_sales_details" else silver.JOBS[name](rows)
            columns = SILVER[name].fieldNames()
            write_table(silver.with_load_time(rows), self.root, f"silver.{name}", columns)

    def load_gold(self) -> None:
        """Dimensions first: their keys are fixed once stored, so fact and checks agree."""
        s = {name: self.table(f"silver.{name}") for name in SILVER}
        customers = gold.dim_customers(
            s["crm_cust_info"], s["erp_cust_az12"], s["erp_loc_a101"], f"{self.root}/staging/dim_customers"
        )
        products = gold.dim_products(
            s["crm_prd_info"], s["erp_px_cat_g1v2"], f"{self.root}/staging/dim_products"
        )
        customers = write_table(customers, self.root, "gold.dim_customers", GOLD["dim_customers"].fieldNames())
        products = write_table(products, self.root, "gold.dim_products", GOLD["dim_products"].fieldNames())
        write_table(gold.fact_sales(s["crm_sales_details"], products, customers), self.root, "gold.fact_sales")

    def contract(self, table: str, strict: bool = True) -> DataFrame:
        path = self.artifacts(f"{table.replace('.', '_')}_contract")
        return enforce(self.table(table), self.contracts[table], path, strict)

    def expectations(self, layer: str) -> DataFrame:
        batches = [(self.table(t), s) for t, s in quality.layer_suites(layer).items()]
        return run_checkpoint(layer, batches, self.artifacts("validations"))

    def checks(self, layer: str) -> DataFrame:
        """Results of the layer's checks, with reports and issue files stored."""
        given = self.catalogue
        wanted = layer_checks(given.layers if given else quality.CHECKS, layer)
        files = given.files if given else quality.ISSUE_FILES
        policy = self.policy or (given.policy() if given else tiered())
        results = run_checks(self.spark, wanted, None, policy)
        write_summary(results, self.artifacts(f"{layer}_quality_summary"))
        write_report(results, layer, self.artifacts(f"{layer}_quality_report"), self.detailed_report)
        clean = {r.check_name for r in results.collect() if r.error is None and r.issues_found == 0}
        write_issues(self.spark, wanted, self.artifacts("issues"), None, files, clean)
        if given:
            given.score(results).coalesce(1).write.mode("overwrite").json(self.artifacts(f"{layer}_score"))
        alerts(results).write.mode("overwrite").json(self.artifacts(f"{layer}_alerts"))
        return results

    def profile(self, layer: str, exact: bool = False) -> DataFrame:
        tables = {t: self.table(t) for t in quality.PROFILED[layer]}
        path = self.artifacts(f"{layer}_profile")
        profile_layer(tables, exact).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    # --- a whole run --------------------------------------------------------------------

    def steps(self) -> list[tuple[str, Callable[[], object]]]:
        return [
            ("define", self.define),
            ("load_bronze", self.load_bronze),
            ("contract_bronze", lambda: self.contract("bronze.crm_cust_info")),
            ("load_silver", self.load_silver),
            ("contract_silver", lambda: self.contract("silver.crm_cust_info")),
            ("expectations_silver", lambda: self.expectations("silver")),
            ("checks_silver", lambda: self.checks("silver")),
            ("profile_silver", lambda: self.profile("silver")),
            ("load_gold", self.load_gold),
            ("contract_gold", lambda: self.contract("gold.dim_customers")),
            ("expectations_gold", lambda: self.expectations("gold")),
            ("checks_gold", lambda: self.checks("gold")),
            ("profile_gold", lambda: self.profile("gold")),
        ]

    def build(self, run: str | None = None) -> DataFrame:
        """Run all steps in order and return the run log. The first step that raises, such as
        a broken contract, ends the run with `StepFailed`, after an alert is stored for it."""
        run = run or f"{dt.datetime.now():%Y%m%d-%H%M%S}"
        log: list[tuple] = []

        def note(pos: int, step: str, state: str, message: str | None = None) -> None:
            log.append((run, pos, step, state, dt.datetime.now(), message))

        def stored() -> DataFrame:
            rows = few_rows(self.spark, log, LOG_SCHEMA)
            rows.coalesce(1).write.mode("overwrite").parquet(self.artifacts("runs", run))
            return rows

        for pos, (step, action) in enumerate(self.steps()):
            note(pos, step, "running")
            try:
                action()
            except Exception as error:
                reason = str(error).splitlines()[0]
                note(pos, step, "failed", reason)
                alert = few_rows(self.spark, [(run, step, "FAIL", f"step {step} failed: {reason}")], ALERT_SCHEMA)
                alert.coalesce(1).write.mode("overwrite").json(self.artifacts("run_alerts", run))
                raise StepFailed(step, error, stored(), alert) from error
            note(pos, step, "success")
        return stored()
