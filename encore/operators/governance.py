"""Lineage and audit tables, compliance and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.times import days_before, moment

LINEAGE_SCHEMA = (
    "lineage_id string, source string, target string, transformation string, timestamp timestamp_ntz, "
    "metadata map<string,string>"
)
AUDIT_SCHEMA = (
    "audit_id string, user string, resource string, action string, timestamp timestamp_ntz, details map<string,string>"
)
# fixed values: regulation names
REGULATIONS = {
    "AUDIT_REQUIRED": "No recent audit logs found",
    "ACCESS_CONTROL": "No access controls configured",
    "LINEAGE_TRACKING": "No lineage information available",
}


def append_records(records: DataFrame, folder: str) -> None:
    """Append lineage or audit rows, one folder per day."""
    records.withColumn("day", F.to_date("timestamp")).write.mode("append").partitionBy("day").parquet(folder)


def lineage_of(lineage: DataFrame, resource: str, direction: str = "both") -> DataFrame:
    """Edges one step up (into the resource) and down (out of it)."""
    up = lineage.filter(F.col("target") == resource).withColumn("direction", F.lit("upstream"))
    down = lineage.filter(F.col("source") == resource).withColumn("direction", F.lit("downstream"))
    if direction == "both":
        return up.unionByName(down)
    if direction in ("upstream", "downstream"):
        return up if direction == "upstream" else down
    raise ValueError(f"unknown direction {direction}")


def audit_report(
    audits: DataFrame, as_of: str, days: int = 7, user: str | None = None, resource: str | None = None
) -> DataFrame:
    found = audits.filter(F.col("timestamp") >= moment(days_before(as_of, days)))
    if user is not None:
        found = found.filter(F.col("user") == user)
    if resource is not None:
        found = found.filter(F.col("resource") == resource)
    return found


def compliance(
    datasets: DataFrame, audits: DataFrame, permissions: DataFrame, lineage: DataFrame, as_of: str
) -> DataFrame:
    """Violations of each dataset (dataset, regulations) against the three tables, all datasets at once."""
    recent = audit_report(audits, as_of, days=1).select(F.col("resource").alias("dataset"))
    allowed = permissions.select(F.col("resource").alias("dataset"))
    edges = lineage.select(F.explode(F.array("source", "target")).alias("dataset"))
    out = datasets
    for flag, known in (("audited", recent), ("controlled", allowed), ("traced", edges)):
        out = out.join(known.distinct().withColumn(flag, F.lit(True)), "dataset", "left")
    named = [
        F.when(F.array_contains("regulations", rule) & F.col(flag).isNull(), F.lit(REGULATIONS[rule]))
        for rule, flag in (("AUDIT_REQUIRED", "audited"), ("ACCESS_CONTROL", "controlled"), ("LINEAGE_TRACKING", "traced"))
    ]
    violations = F.array_compact(F.array(*named))
    return out.select("dataset", violations.alias("violations"), (F.size(violations) == 0).alias("compliant"))


def governance_summary(audits: DataFrame, permissions: DataFrame, as_of: str) -> DataFrame:
    granted = permissions.agg(F.count(F.lit(1)).alias("n")).scalar()
    return audit_report(audits, as_of, 7).agg(F.count(F.lit(1)).alias("audit_logs_last_7_days")).withColumn(
        "total_permissions", granted
    )
