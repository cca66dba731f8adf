"""Departments, agencies and subagencies of workforce tables: choice of the file, its columns, records."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import collapse, strip, text

SOURCE = "OPM Federal Workforce Data"
# Spellings of the columns, letters and digits in lower case, the first that occurs counts; departments that
# only gather agencies; names of the months.
COLUMNS = {
    "department": ("department", "departmentname", "deptname"),
    "department_code": ("departmentcode", "deptcode"),
    "agency": ("agency", "agencyname"),
    "agency_code": ("agencycode", "agy"),
    "subagency": ("subagency", "subagencyname", "agencysubelement", "agencysubelementname", "agencysubelementtranslation", "agysubt"),
    "subagency_code": ("subagencycode", "agencysubelementcode", "agysub"),
}
NEEDED = ("agency", "subagency")
SYNTHETIC = ("non-cfo act agency", "other", "unknown", "not reported", "")
MONTHS = "january february march april may june july august september october november december".split()


def columns(names: list[str]) -> dict[str, str]:
    """Which of the table's columns is which; an optional one that is missing is empty."""
    known = {re.sub("[^a-z0-9]", "", n.lower()): n for n in names}
    out = {c: next((known[s] for s in spellings if s in known), "") for c, spellings in COLUMNS.items()}
    if missing := [c for c in NEEDED if not out[c]]:
        raise ValueError(f"the workforce table lacks {missing}; it has {sorted(names)}")
    return out


def month_number(c: Column | str) -> Column:
    """A month as two digits, from a number or an English name, whole or its first three letters (sept, too); others as they are."""
    value = strip(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"))
    low = F.lower(value)
    number = F.coalesce(*[F.when(low.isin(m, m[:3], *(["sept"] if m == "september" else [])), f"{i:02d}") for i, m in enumerate(MONTHS, 1)])
    return F.when(value.rlike(r"^\d+$"), F.when(F.length(value) < 2, F.lpad(value, 2, "0")).otherwise(value)).otherwise(F.coalesce(number, value))


def listed_files(payload: str | bytes) -> list[tuple[str, str, str, str]]:
    """(captured through, year, month, version) of the files that an answer of the list of files names."""
    data = json.loads(payload)
    if isinstance(data, dict):
        data = next((data[k] for k in ("results", "data", "files") if data.get(k)), [])
    if not isinstance(data, list):
        raise ValueError("the list of workforce files is no list")
    told = lambda x, *keys: next((str(x[k]) for k in keys if x.get(k) not in (None, "")), "")
    return [(told(x, "dataCapturedThrough", "data_captured_through"), told(x, "year"), told(x, "month"), told(x, "version")) for x in data]


def newest_file(files: DataFrame) -> DataFrame:
    """The row of files (captured, year, month, version: text) that was captured last; of equals the latest year, month, version.

    With month as two digits, and data_as_of: the captured date or year-month.
    """
    whole = lambda c: F.coalesce(F.expr(f"try_cast({c} as int)"), F.lit(0))
    top = files.orderBy(F.desc(text("captured")), F.desc(whole("year")), F.desc(whole("month")), F.desc(whole("version"))).limit(1)
    top = top.withColumn("month", month_number("month"))
    return top.withColumn("data_as_of", F.when(text("captured") != "", F.col("captured")).otherwise(F.concat_ws("-", "year", "month")))


def strip_code_prefix(name: Column | str, code: Column | str) -> Column:
    """The name without its code, or without a code of 3 to 6 capitals or digits, and the dash or colon behind it."""
    value, own = collapse(name), collapse(code)
    cut = strip(F.regexp_replace(value, F.concat(F.lit(r"(?i)^\Q"), own, F.lit(r"\E\s*[-–—:]\s*")), F.lit("")))
    return F.when((own != "") & (cut != value), cut).otherwise(strip(F.regexp_replace(value, r"^[A-Z0-9]{3,6}\s*[-–—:]\s*", "")))


def record_id(level: Column | str, code: Column | str, name: Column | str) -> Column:
    """level:code, or without a code level:name with everything but letters and digits as single dashes."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(text(name)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.concat_ws(":", level, F.when(text(code) != "", text(code)).otherwise(slug))


def workforce_records(table: DataFrame, as_of: str = "", url: str = "") -> DataFrame:
    """Records of the organizations in a workforce table; rec_idx holds the order of its rows.

    A table without departments has its agencies in their place. Departments that only gather others give no record and
    are no parents; an agency named like its department has no parent; a subagency named like its agency is left out. Of
    rows with one code, or one name without a code, the last counts.
    """
    found = columns([c for c in table.columns if c != "rec_idx"])
    own = lambda c: collapse(F.col(f"`{found[c]}`").cast("string")) if found[c] else F.lit("")
    rows = table.select("rec_idx", *[own(c).alias(c) for c in COLUMNS])
    if not found["department"]:
        rows = rows.withColumn("department", F.col("agency"))
    rows = rows.withColumn("subagency", strip_code_prefix("subagency", "subagency_code"))
    synthetic = F.lower("department").isin(*SYNTHETIC)
    none = F.lit("")
    codes = ("department_code", "agency_code", "subagency_code")
    level = lambda name, code, parent, keep, known: F.struct(
        F.lit(name).alias("source_level"), F.col(name).alias("source_name"), F.col(code).alias("code"), parent.alias("parent_source_name"), keep.alias("keep"),
        *[(F.col(c) if i < known else none).alias(f"opm_{c}") for i, c in enumerate(codes)],
    )
    rows = rows.select("rec_idx", F.explode(F.array(
        level("department", "department_code", none, ~synthetic, 1),
        level("agency", "agency_code", F.when(synthetic | (F.col("agency") == F.col("department")), none).otherwise(F.col("department")), F.col("agency") != "", 2),
        level("subagency", "subagency_code", F.when(F.col("agency") != "", F.col("agency")).otherwise(F.col("department")), (F.col("subagency") != "") & (F.col("subagency") != F.col("agency")), 3),
    )).alias("r")).filter("r.keep")
    key = F.when(F.col("r.code") != "", F.col("r.code")).otherwise(F.lower("r.source_name"))
    last = rows.groupBy("r.source_level", key.alias("key")).agg(F.max_by("r", "rec_idx").alias("r")).select("r.*")
    given = {"source": F.lit(SOURCE), "source_record_id": record_id("source_level", "code", "source_name"), "source_url": F.lit(url), "branch": F.lit("Executive Branch"), "source_as_of": F.lit(as_of), "data_as_of": F.lit(as_of)}
    names = ("source", "source_record_id", "source_name", "source_url", "website", "description", "parent_source_name", "source_level", "branch", "source_as_of", "data_as_of", *(f"opm_{c}" for c in codes))
    return last.select(*[(given[c] if c in given else F.col(c) if c in last.columns else none).alias(c) for c in names]).orderBy("source_level", F.lower("source_name"))
