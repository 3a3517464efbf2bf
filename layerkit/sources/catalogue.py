"""Check catalogues from YAML files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from layerkit.operators.checks import (
    PASS_THRESHOLD,
    SEVERITY_WEIGHTS,
    Check,
    CheckError,
    Policy,
    QueryCheck,
    Tables,
    layer_checks,
    run_checks,
    tiered,
    weighted_score,
)


@dataclass(frozen=True)
class Catalogue:
    layers: dict[str, Sequence[Check]]
    pass_threshold: float
    severity_weights: dict[str, float]
    files: dict[str, str]  # check name -> issue file it asks for

    def policy(self) -> Policy:
        """The tiered rule at the catalogue's threshold."""
        return tiered(self.pass_threshold)

    def run(self, spark: SparkSession, layer: str, tables: Tables | None = None) -> DataFrame:
        """Results of a layer's checks at the catalogue's threshold."""
        return run_checks(spark, layer_checks(self.layers, layer), tables, self.policy())

    def score(self, results: DataFrame) -> DataFrame:
        return weighted_score(results, self.severity_weights)


def load_catalogue(path: str) -> Catalogue:
    """Read `quality_checks: {layer: [{name, table, issue_query, ...}]}` and
    `quality_thresholds: {pass_threshold, severity_weights}`. Any problem is a CheckError."""
    try:
        import yaml

        with open(path, encoding="utf-8") as f:
            spec = yaml.safe_load(f)
        thresholds = spec.get("quality_thresholds") or {}
        layers, files = {}, {}
        for layer, entries in (spec.get("quality_checks") or {}).items():
            layers[layer] = [
                QueryCheck(
                    name=e["name"],
                    table=e["table"],
                    issues=e["issue_query"],
                    severity=e.get("severity", "medium"),
                    description=e.get("description", ""),
                )
                for e in entries or []
            ]
            files.update({e["name"]: e["csv_file"] for e in entries or [] if e.get("csv_file")})
        return Catalogue(
            layers,
            float(thresholds.get("pass_threshold", PASS_THRESHOLD)),
            dict(thresholds.get("severity_weights") or SEVERITY_WEIGHTS),
            files,
        )
    except Exception as error:
        raise CheckError(f"cannot load check catalogue {path}: {error}") from error
