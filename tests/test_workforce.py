import pytest

from entigraph.sources import workforce as W


def table(spark, names, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "rec_idx long, " + ", ".join(f"`{n}` string" for n in names))


def records(df):
    return {r.source_record_id: r for r in W.workforce_records(df, "07/31/2026", "u").collect()}


def test_three_levels(spark):
    names = ("department", "department_code", "agency", "agency_code", "agency_subelement", "agency_subelement_code")
    out = records(table(spark, names, ("Department of Agriculture", "AG", "Department of Agriculture", "AG", "AG02-Agricultural  Marketing Service", "AG02"), ("Department of X", "XX", "AF01-Air Command", "", "XX9 - XX9-Deep", "XX9")))
    sub = out["subagency:AG02"]
    assert (sub.source_name, sub.parent_source_name, sub.opm_subagency_code, sub.opm_department_code, sub.source_as_of) == ("Agricultural Marketing Service", "Department of Agriculture", "AG02", "AG", "07/31/2026")
    assert out["agency:AG"].parent_source_name == "" and (out["department:AG"].opm_agency_code, out["department:AG"].branch) == ("", "Executive Branch")
    # only subagencies lose the code before the name; without a code a name makes the id
    assert (out["agency:af01-air-command"].source_name, out["agency:af01-air-command"].parent_source_name) == ("AF01-Air Command", "Department of X")
    assert out["subagency:XX9"].source_name == "XX9-Deep"


def test_tables_without_departments(spark):
    out = records(table(spark, ("Agency Name", "AGY", "AGYSUBT", "agysub"), ("DEPARTMENT OF THE TREASURY", "TR", "INTERNAL REVENUE SERVICE", "TR93")))
    assert {r.source_name for r in out.values()} == {"DEPARTMENT OF THE TREASURY", "INTERNAL REVENUE SERVICE"} and out["agency:TR"].parent_source_name == ""
    with pytest.raises(ValueError, match="subagency"):
        W.columns(["department", "agency"])


def test_gathering_departments_and_last_rows(spark):
    names = ("department", "agency", "agency_subelement", "agency_subelement_code")
    rows = [(d, "Small  Board" if d else None, None, None) for d in ("Non-CFO Act Agency", "Other", "UNKNOWN", "Not Reported", "")]
    out = records(table(spark, names, *rows, ("Other agencies", "Peace Corps", "PU00-Peace Corps", "PU00"), ("Other agencies", "Peace Corps", "Corps of Peace", "PU00")))
    assert set(out) == {"agency:small-board", "department:other-agencies", "agency:peace-corps", "subagency:PU00"}
    assert out["agency:small-board"].parent_source_name == "" and out["subagency:PU00"].source_name == "Corps of Peace"


def test_files_and_months(spark):
    files = W.listed_files('{"results": [{"dataCapturedThrough": "2026-05", "year": 2026, "month": "May", "version": 9}, {"data_captured_through": "2026-07", "year": 2026, "month": 7, "version": 10}, {"dataCapturedThrough": "2026-07", "year": 2026, "month": 7, "version": 9}]}')
    top = W.newest_file(spark.createDataFrame(files, "captured string, year string, month string, version string")).first()
    assert (top.year, top.month, top.version, top.data_as_of) == ("2026", "07", "10", "2026-07")
    months = spark.createDataFrame([("Sept",), ("december",), (" 3 ",), ("11",), ("Q1",), ("may",), (None,)], "m string")
    assert [r[0] for r in months.select(W.month_number("m")).collect()] == ["09", "12", "03", "11", "Q1", "05", ""]
    with pytest.raises(ValueError):
        W.listed_files('{"results": 3}')
