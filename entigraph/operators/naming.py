"""Canonical names by the authority of their sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from .graph import reliable


def structural_unit(df: DataFrame, loose_level: bool) -> Column:
    """The code of an OPM unit that its department, agency and default subagency rows share, else the empty string.

    loose_level: the level in any case and the source by its exact name; else the level as it is and the source by tier.
    """
    col = lambda c: N.strip(c) if c in df.columns else F.lit("")
    level = F.lower(N.strip("source_level")) if loose_level else N.text("source_level")
    dept, agency, sub = col("opm_department_code"), col("opm_agency_code"), col("opm_subagency_code")
    is_opm = N.text("source") == "OPM Federal Workforce Data" if loose_level else N.source_tier("source") == "opm_fwd"
    unit = (level == "department") | (level == "agency") & (agency == dept) | (level == "subagency") & (agency == dept) & (sub == F.concat(agency, F.lit("00")))
    return F.when(is_opm & (dept != "") & unit, dept).otherwise(F.lit(""))


def _disagreeing(asked: DataFrame) -> DataFrame:
    """The roots of (root, asked: sorted distinct names) of which a name differs in substance from the first.

    Forms and keys are made once for each distinct name, however many roots have it.
    """
    some = reliable(asked.filter(F.size("asked") > 1).select("root", F.explode("asked").alias("name")))
    forms = some.select("name").distinct().withColumns({"norm": N.normalize_name("name"), "moved": N.moved_designator("name"), "keys": N.identity_keys("name")})
    named = some.join(forms, "name").groupBy("root").agg(F.sort_array(F.collect_list(F.struct("name", "norm", "moved", "keys"))).alias("named"))
    first = F.col("named")[0]
    same = lambda n: (n["norm"] == first["norm"]) | (n["moved"] == first["moved"]) | F.arrays_overlap(n["keys"], first["keys"])
    return named.filter(F.exists("named", lambda n: ~same(n))).select("root", F.lit(True).alias("differs"))


def choose_names(records: DataFrame, preferred: DataFrame) -> DataFrame:
    """One choice per root: name, source, source_record_id, as_of, tier, status, needs_review, variants.

    records: root, rec_idx and the source columns; preferred: root, preferred_name. The latest manual name wins, then a
    reviewed name, then the order OPM, Federal Register, USA.gov, others.
    """
    as_of = F.lit("")
    for c in ("data_as_of", "publication_date", "source_as_of"):
        if c in records.columns:
            as_of = F.when(N.text(c) != "", N.text(c)).otherwise(as_of)
    rows = records.filter(N.strip("source_name") != "").select(
        "root", "rec_idx", N.text("source").alias("source"), N.text("source_record_id").alias("rid"), N.text("source_level").alias("level"),
        N.strip(as_of).alias("as_of"), N.source_tier("source").alias("tier"), structural_unit(records, False).alias("unit"),
        N.strip("source_name").alias("exact"), N.strip_parenthetical_acronym("source_name").alias("shown"),
    )
    rank = F.when(F.col("tier") == "govinfo_govman", 0).when(F.col("tier") == "opm_fwd", 1).when(F.col("tier") == "federal_register", 2).when(F.col("tier") == "usagov", 3).otherwise(4)
    office = F.lit(False)
    for p in ("office of ", "bureau of ", "national institute of "):
        office = office | N.normalize_name("shown").startswith(p)
    order = F.struct(
        -rank, "as_of", ((F.col("unit") != "") & (F.col("level") == "department")).cast("int"), office.cast("int"),
        (~F.col("shown").contains(",")).cast("int"), F.length("shown"), F.lower("exact"), "rid", -F.col("rec_idx"),
    )
    best = rows.groupBy("root").agg(F.max_by(F.struct("source", "rid", "as_of", "tier", "unit", "exact", "shown"), order).alias("c"))
    rows = rows.join(best, "root")
    gov = F.col("tier") == "govinfo_govman"
    latest = gov & ((F.col("c.as_of") == "") | (F.col("as_of") == F.col("c.as_of")))
    shorter = (F.col("c.unit") != "") & (F.col("unit") == F.col("c.unit")) & (F.length("shown") < F.length("c.shown"))
    named = rows.groupBy("root").agg(
        F.first("c").alias("c"),
        F.sort_array(F.collect_set(F.when(latest, F.col("exact")))).alias("latest"),
        F.sort_array(F.collect_set(F.when(~shorter, F.col("shown")))).alias("compared"),
        F.sort_array(F.collect_set(F.when(F.col("shown") != "", F.col("shown")))).alias("all_names"),
    )
    named = reliable(named.join(preferred, "root", "left"))
    is_gov = F.col("c.tier") == "govinfo_govman"
    human = ~is_gov & (N.text("preferred_name") != "")
    asked = named.filter(~human).select("root", F.when(is_gov, F.col("latest")).otherwise(F.col("compared")).alias("asked"))
    named = named.join(_disagreeing(asked), "root", "left")
    conflict = F.coalesce("differs", F.lit(False))
    pick = lambda g, h, other: F.when(is_gov, g).when(human, h).otherwise(other)
    return named.select(
        "root",
        pick(F.col("c.exact"), N.strip("preferred_name"), F.col("c.shown")).alias("name"),
        pick(F.col("c.source"), F.lit("Human-reviewed identity override"), F.col("c.source")).alias("name_source"),
        pick(F.col("c.rid"), F.lit(""), F.col("c.rid")).alias("name_record_id"),
        pick(F.col("c.as_of"), F.lit(""), F.col("c.as_of")).alias("name_as_of"),
        pick(F.lit("govinfo_govman"), F.lit("human_review"), F.col("c.tier")).alias("tier"),
        F.when(is_gov & conflict, "GovInfo conflict - naming review").when(is_gov, "GovInfo authoritative").when(human, "Reviewed fallback name").when(conflict, "Fallback provisional - naming review").otherwise("Fallback source hierarchy").alias("name_status"),
        conflict.alias("needs_review"),
        F.when(is_gov, F.col("latest")).otherwise(F.col("all_names")).alias("variants"),
    )
