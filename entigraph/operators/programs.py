"""Programs: mapping to organizations, clustering, purposes, review pairs and gap reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from .graph import connected_components, reliable
from .ordered import first_by
from .similar import name_form, similar_forms

#: Which source names a program, lowest first; 999 for others.
PRIORITY = {"sam_assistance": 10, "treasury_tax_expenditures": 20, "performance_fpi_archive": 30, "supplemental": 90}
LEVELS = ("office", "agency", "department")
#: What tells which organization a record means: a name, its place among LEVELS, the normalised department.
ASKED = ["level", "name", "dept"]


def organization_index(orgs: DataFrame, aliases: DataFrame, sources: DataFrame) -> dict[str, DataFrame]:
    """names (key, ids), variants (key, ids), parents (org_id, parents) and canonical (org_id, name)."""
    given = orgs.select(F.col("external_id").alias("org_id"), F.col("canonical_name").alias("name"))
    given = given.union(aliases.select("organization_id", "alias")).union(sources.select("canonical_external_id", "source_name"))
    given = given.filter((N.text("org_id") != "") & (N.text("name") != ""))
    grouped = lambda key: given.select(key.alias("key"), "org_id").groupBy("key").agg(F.sort_array(F.collect_set("org_id")).alias("ids"))
    parents = sources.select(F.col("canonical_external_id").alias("org_id"), N.normalize_name("parent_source_name").alias("p")).filter("org_id <> '' and p <> ''")
    return {
        "names": grouped(N.normalize_name("name")),
        "variants": grouped(F.explode(N.identity_keys("name"))),
        "parents": parents.groupBy("org_id").agg(F.collect_set("p").alias("parents")),
        "canonical": orgs.groupBy(F.col("external_id").alias("organization_id")).agg(F.last("canonical_name").alias("organization_canonical_name")),
    }


def _with_parents(rows: DataFrame, by: str, index: dict[str, DataFrame], out: str) -> DataFrame:
    """(by, out: sorted structs of id and parents) for (by, id) rows."""
    rows = rows.join(index["parents"].withColumnRenamed("org_id", "id"), "id", "left")
    one = F.struct("id", F.coalesce("parents", F.array().cast("array<string>")).alias("parents"))
    return rows.groupBy(by).agg(F.sort_array(F.collect_set(one)).alias(out))


def map_organizations(records: DataFrame, index: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The records with their administering organization, and the review rows of those without one.

    Office, agency and department are tried in turn. The department that a record names settles which of several
    organizations of one name is meant, and finds variants of a name beneath it. What a name means is told by itself, its
    level and the department, so it is looked up once for all records that have these: only the answer goes to each.
    """
    at = F.posexplode(F.array(*[N.text(f"{x}_source_name") for x in LEVELS])).alias("level", "name")
    levels = records.select("rec_idx", N.normalize_name("department_source_name").alias("dept"), at)
    levels = reliable(levels.filter("name <> ''"))
    asked = reliable(levels.select(*ASKED).distinct().withColumn("key", N.normalize_name("name")).filter("key <> ''"))
    base = _with_parents(asked.select("key").distinct().join(index["names"], "key").select("key", F.explode("ids").alias("id")), "key", index, "base")
    like = asked.filter("level < 2 and dept <> ''").select("name").distinct().select("name", F.explode(N.identity_keys("name")).alias("key")).join(index["variants"], "key")
    like = _with_parents(like.select("name", F.explode("ids").alias("id")).distinct(), "name", index, "like")
    empty = F.array().cast("array<struct<id:string,parents:array<string>>>")
    df = asked.join(base, "key", "left").join(like, "name", "left").withColumn("base", F.coalesce("base", empty)).withColumn("like", F.coalesce("like", empty))
    under = lambda c: F.filter(c, lambda o: F.array_contains(o["parents"], F.col("dept")))
    lower = (F.col("level") < 2) & (F.col("dept") != "")
    df = df.withColumn("ids", F.when((F.size("base") > 1) & lower & (F.size(under("base")) > 0), under("base")).otherwise(F.col("base")))
    known = F.size(F.col("ids")[0]["parents"]) > 0
    need = F.when(F.size("ids") == 0, True).when(F.size("ids") > 1, F.size(under("ids")) == 0).otherwise(known & (F.size(under("ids")) == 0))
    better = (F.size(under("like")) == 1) | (F.size("ids") != 1) & (F.size(under("like")) > 0)
    df = df.withColumn("ids", F.when(need & lower & better, under("like")).otherwise(F.col("ids")))
    level_name = F.element_at(F.array(*map(F.lit, LEVELS)), F.col("level") + 1)
    exact = (F.size("base") == 1) & (F.col("base")[0]["id"] == F.col("ids")[0]["id"])
    method = F.when(exact, F.concat(F.lit("exact_"), level_name, F.lit("_name_or_alias"))).otherwise(F.concat(level_name, F.lit("_name_or_alias_with_parent")))
    meant = reliable(df.filter("size(ids) > 0").select(*ASKED, F.size("ids").alias("n"), F.col("ids")[0]["id"].alias("organization_id"), method.alias("organization_mapping_method"), F.when(F.size("ids") > 1, F.array_join("ids.id", "|")).alias("cand")))
    hit = levels.join(meant.filter("n = 1"), ASKED).select(
        "rec_idx", "level", "organization_id", "organization_mapping_method", F.col("name").alias("organization_source_name_used"), level_name.alias("organization_source_level_used"),
    )
    hit = first_by(hit, ["rec_idx"], F.col("level")).drop("level")
    several = meant.filter("n > 1").select(*ASKED, "cand")
    open_ = first_by(levels.join(several.drop("cand"), ASKED).select("rec_idx", *ASKED), ["rec_idx"], F.col("level"))
    open_ = open_.join(several, ASKED).select("rec_idx", "level", "name", level_name.alias("level_name"), "cand")
    out = records.join(hit, "rec_idx", "left").join(index["canonical"], "organization_id", "left")
    for c in ("organization_id", "organization_canonical_name", "organization_mapping_method", "organization_source_name_used", "organization_source_level_used"):
        out = out.withColumn(c, N.text(c))
    missing = out.filter("organization_id = ''").join(open_, "rec_idx", "left")
    all_names = F.array_join(F.filter(F.array(*[N.text(f"{x}_source_name") for x in LEVELS]), lambda n: n != ""), " | ")
    several = F.col("level").isNotNull()
    review = missing.select(
        N.source_key("source_key", "source_record_id").alias("program_source_key"), N.text("source_name").alias("program_source_name"),
        F.when(several, F.col("name")).otherwise(all_names).alias("organization_source_name"), N.text("level_name").alias("organization_source_level"),
        F.when(several, "ambiguous_exact_organization_match").otherwise("no_exact_organization_match").alias("issue"), N.text("cand").alias("candidate_organization_ids"),
    )
    return out, review


def citations(authorities: DataFrame) -> DataFrame:
    """(key, usc): the code sections that a program's authorities cite."""
    title, section = N.strip("usc_title"), N.strip("usc_section")
    return authorities.filter((title != "") & (section != "")).select(N.source_key("source_key", "program_source_record_id").alias("key"), F.concat_ws(":", title, section).alias("usc")).distinct()


def resolve(records: DataFrame, authorities: DataFrame, functions: DataFrame, orgs: DataFrame, aliases: DataFrame, sources: DataFrame) -> dict[str, DataFrame]:
    """All tables of the programs flow. records and authorities carry rec_idx and auth_idx, their source order."""
    mapped, org_review = map_organizations(records, organization_index(orgs, aliases, sources))
    mapped = reliable(mapped.withColumn("key", N.source_key("source_key", "source_record_id")))
    usc = reliable(citations(authorities))
    nodes = reliable(mapped.groupBy("key").agg(F.min("rec_idx").alias("id")))  # rows of one key are one program
    row = mapped.join(nodes, "key").select("id", "key", "rec_idx", N.text("source_name").alias("name"), "organization_id", N.normalize_name("source_name").alias("norm"))
    row = reliable(row)
    by_name = row.filter("norm <> '' and organization_id <> ''")
    star = by_name.groupBy("norm", "organization_id").agg(F.min("id").alias("a")).join(by_name.select("norm", "organization_id", F.col("id").alias("b")), ["norm", "organization_id"]).select("a", "b")
    cited = row.filter("organization_id <> ''").join(usc, "key").select(F.concat_ws("|", "usc", "organization_id").alias("g"), "id", name_form("name").alias("form"))
    by_form = reliable(cited.filter("form <> ''").groupBy("g", "form").agg(F.min("id").alias("a"), F.collect_set("id").alias("ids")))
    one = lambda c: by_form.select("g", F.col("form").alias(c), F.col("a").alias(f"{c}_id"))
    close = similar_forms(by_form, 92).join(one("a"), ["g", "a"]).join(one("b"), ["g", "b"]).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))
    close = close.union(by_form.select("a", F.explode("ids").alias("b")))
    group = reliable(connected_components(nodes.select("id"), star.union(close)))
    member = reliable(mapped.join(nodes, "key").join(group, "id"))

    priority = F.lit(999)
    for source, p in PRIORITY.items():
        priority = F.when(F.col("source_key") == source, F.lit(p)).otherwise(priority)
    purpose = N.strip("agency_stated_purpose")
    law = authorities.filter(N.text("statutory_purpose_text") != "").select(N.source_key("source_key", "program_source_record_id").alias("key"), "auth_idx", N.text("statutory_purpose_text").alias("law"))
    law = law.join(member.select("key", "root").distinct(), "key").groupBy("root").agg(F.min_by("law", "auth_idx").alias("law"))
    rows = member.groupBy("root").agg(
        F.min_by(F.struct("key", N.strip("source_name").alias("name"), N.text("source_status").alias("status")), F.struct(priority, "key", "rec_idx")).alias("anchor"),
        F.sort_array(F.collect_set(F.when(F.col("organization_id") != "", F.col("organization_id")))).alias("org_ids"),
        F.bool_or(F.col("source_key") == "treasury_tax_expenditures").alias("tax"),
        F.min_by(F.when(purpose != "", purpose), F.when(purpose != "", F.col("rec_idx"))).alias("agency"),
        F.count("*").alias("source_count"),
    ).join(law, "root", "left")
    rows = reliable(rows.withColumn("program_id", N.program_id("anchor.key")))
    programs = rows.select(
        "program_id", F.col("anchor.name").alias("canonical_name"), F.when(F.col("tax"), "tax_expenditure").otherwise("").alias("program_type"),
        F.coalesce("law", "agency", F.lit("")).alias("canonical_purpose"), F.when(F.col("law").isNotNull(), "statutory").when(F.col("agency").isNotNull(), "agency_stated").otherwise("").alias("canonical_purpose_type"),
        F.col("anchor.status").alias("status"), F.when(F.size("org_ids") == 1, F.col("org_ids")[0]).otherwise("").alias("primary_organization_id"), "source_count",
        F.when(F.size("org_ids") <= 1, "resolved").otherwise("needs_review").alias("resolution_status"),
    )
    ids = reliable(rows.select("root", "program_id"))
    placed = member.join(ids, "root")
    text = lambda c: N.strip(c) if c in member.columns else F.lit("")
    alias = placed.select("program_id", "rec_idx", "source_key", "source_record_id", F.explode(F.array_distinct(F.array(text("source_name"), text("popular_long_name"), text("popular_short_name")))).alias("alias")).filter("alias <> ''")
    alias = first_by(alias, ["program_id", "alias"], F.col("rec_idx")).select("program_id", "alias", "source_key", "source_record_id")
    edges = placed.filter("organization_id <> ''").select("program_id", "organization_id", F.lit("administered_by").alias("relationship_type"), "source_key", "source_record_id", F.col("organization_mapping_method").alias("mapping_method"))
    key_id = reliable(placed.select("key", "program_id").distinct())

    # pairs with an organization or a citation in common; a key stands for its last row
    last = first_by(member.select("key", "rec_idx", N.text("source_name").alias("name"), "organization_id", "root"), ["key"], -F.col("rec_idx")).join(key_id, "key")
    last = last.join(usc.groupBy("key").agg(F.sort_array(F.collect_set("usc")).alias("uscs")), "key", "left").withColumn("uscs", F.coalesce("uscs", F.array().cast("array<string>")))
    last = reliable(last)
    placed_in = last.select(F.explode(F.concat(F.when(F.col("organization_id") != "", F.array(F.concat(F.lit("o:"), "organization_id"))).otherwise(F.array().cast("array<string>")), F.transform("uscs", lambda u: F.concat(F.lit("u:"), u)))).alias("g"), name_form("name").alias("form"), "root", "key")
    placed_in = reliable(placed_in.filter("form <> ''"))
    alike = similar_forms(placed_in, 88).union(placed_in.select("g", F.col("form").alias("a"), F.col("form").alias("b"), F.lit(100.0).alias("similarity")).distinct())
    # first the programs, then the keys: rows of one program are never paired
    of_root = placed_in.select("g", "form", "root").distinct()
    side = lambda c, r: of_root.select("g", F.col("form").alias(c), F.col("root").alias(r))
    pair = alike.join(side("a", "x"), ["g", "a"]).join(side("b", "y"), ["g", "b"]).filter("x <> y")
    keys = lambda c, r, k: placed_in.select("g", F.col("form").alias(c), F.col("root").alias(r), F.col("key").alias(k))
    pair = pair.join(keys("a", "x", "i"), ["g", "a", "x"]).join(keys("b", "y", "j"), ["g", "b", "y"])
    pair = pair.groupBy(F.least("i", "j").alias("lk"), F.greatest("i", "j").alias("rk")).agg(F.first("similarity").alias("name_similarity"))
    side = lambda k, p: last.select(F.col("key").alias(k), F.struct("name", "organization_id", "program_id", "uscs").alias(p))
    pair = pair.join(side("lk", "l"), "lk").join(side("rk", "r"), "rk")
    pair = pair.withColumn("same_organization", (F.col("l.organization_id") != "") & (F.col("l.organization_id") == F.col("r.organization_id"))).withColumn("shared", F.array_intersect("l.uscs", "r.uscs"))
    candidates = pair.select(F.col("l.program_id").alias("left_program_id"), F.col("r.program_id").alias("right_program_id"), F.col("l.name").alias("left_name"), F.col("r.name").alias("right_name"), "name_similarity", "same_organization", F.array_join(F.sort_array("shared"), "|").alias("shared_usc"), F.lit("review").alias("decision"))

    back = lambda df, key: df.withColumn("key", key).join(key_id, "key", "left").withColumn("program_id", N.text("program_id")).drop("key")
    return {
        "programs": programs,
        "program_sources": placed.drop("key", "id", "root"),
        "program_aliases": alias,
        "program_authorities": back(authorities, N.source_key("source_key", "program_source_record_id")),
        "program_functions": back(functions, N.source_key(F.lit("sam_assistance"), "program_source_record_id")),
        "program_organization_relationships": edges,
        "program_match_candidates": candidates,
        "organization_mapping_review_queue": org_review,
        "programs_without_organizations": programs.filter("primary_organization_id = ''").select("program_id", "canonical_name", "program_type", F.lit("no_resolved_administering_organization").alias("reason")),
        "organizations_without_programs": without_programs(orgs, edges),
    }


def without_programs(orgs: DataFrame, edges: DataFrame) -> DataFrame:
    every = orgs.select(F.col("external_id").alias("organization_id"), "canonical_name").filter("organization_id <> ''")
    return every.join(edges.select("organization_id").distinct(), "organization_id", "left_anti")
