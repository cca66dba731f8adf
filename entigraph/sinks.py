"""Results as CSV tables with a summary of their sizes. All writes go through Spark, so that any store it knows will do."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# File names of the tables, and the names of their row counts in the summaries.
ORGANIZATION_TABLES = [
    ("organizations", "organizations", "canonical_entities"), ("organization_aliases", "organization_aliases", "organization_aliases"),
    ("organization_sources", "organization_sources", "source_records"), ("organization_candidates", "organization_match_candidates", "identity_match_candidates"),
    ("organization_relationships", "organization_relationships", "hierarchy_candidates"), ("organization_review_queue", "organization_review_queue", "review_rows"),
    ("organization_name_review", "organization_name_review_queue", "naming_review_rows"), ("organization_status", "organization_status_evidence", "status_evidence_rows"),
]
PROGRAM_TABLES = [
    ("programs", "canonical_programs"), ("program_sources", "program_source_records"), ("program_authorities", "program_authorities"), ("program_functions", "program_functions"),
    ("program_organization_relationships", "program_organization_relationships"), ("program_match_candidates", "program_identity_review_rows"),
    ("organization_mapping_review_queue", "organization_mapping_review_rows"), ("programs_without_organizations", "programs_without_organizations"),
    ("organizations_without_programs", "organizations_without_programs"),
]


def write_csv(df: DataFrame, path: str, files: int | None = None) -> int:
    """Writes df with a header, lists joined by "|", as a folder of part files (or `files` of them); returns the rows.

    They are counted by the tasks that write them. The job takes each of these tasks into account once, however often it
    had to be tried, so that the count is that of the files.
    """
    flat = [F.array_join(c.name, "|").alias(c.name) if c.dataType.typeName() == "array" else F.col(c.name) for c in df.schema.fields]
    out = df.select(*flat) if files is None else df.select(*flat).coalesce(files)
    seen = Observation()
    out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="")
    return seen.get["rows"]


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, rows) of all tables, in one job."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.lit(name).alias("name"), F.count("*").alias("rows"))
        out = one if out is None else out.union(one)
    return out


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(value, indent=2, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def export_organizations(tables: dict[str, DataFrame], folder: str, metrics: dict | None = None, files: int | None = None) -> dict:
    counts = {name: write_csv(tables[key], f"{folder}/{name}.csv", files) for key, name, _ in ORGANIZATION_TABLES}
    spark = tables["organizations"].sparkSession
    summary = (metrics or {}) | {count: counts[name] for _, name, count in ORGANIZATION_TABLES}
    write_json(spark, summary, f"{folder}/pipeline_summary.json")
    return summary


def export_programs(tables: dict[str, DataFrame], folder: str, metrics: dict | None = None, files: int | None = None) -> dict:
    counts = {name: write_csv(df, f"{folder}/{name}.csv", files) for name, df in tables.items()}
    spark = tables["programs"].sparkSession
    summary = (metrics or {}) | {count: counts.get(name, 0) for name, count in PROGRAM_TABLES}
    write_json(spark, summary, f"{folder}/program_pipeline_summary.json")
    return summary


def post_table(organizations: DataFrame) -> DataFrame:
    """The organizations with title and slug for a content system in front."""
    return organizations.select(F.col("canonical_name").alias("post_title"), F.replace("normalized_name", F.lit(" "), F.lit("-")).alias("post_slug"), "*")
