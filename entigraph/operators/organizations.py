"""Organizations: normalization, identity resolution, overrides, review candidates, hierarchy and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions.similarity import indel_ratio
from ..functions.urls import domain
from .graph import connected_components, constrained_union, reliable
from .naming import choose_names, structural_unit
from .ordered import first_by

KEY_BLOCK, TOKEN_BLOCK = 20, 80  # larger blocks are left out: part of the results, not a limit of this engine
OPM = "OPM Federal Workforce Data"


def normalize_records(records: DataFrame) -> DataFrame:
    """The records with their normal forms; rec_idx must hold the source order."""
    base = N.strip_parenthetical_acronym("source_name")
    return records.withColumns({
        "normalized_name": N.normalize_name("source_name"),
        "base_name": base,
        "identity_keys": N.identity_keys("source_name"),
        "match_tokens": N.matching_tokens(F.when(base != "", base).otherwise(N.text("source_name"))),
        "acronym": N.acronym(base),
        "explicit_acronym": N.explicit_parenthetical_acronym("source_name"),
        "domain": domain("website"),
        "normalized_parent_name": N.normalize_name("parent_source_name"),
    })


def strong_keys(records: DataFrame) -> Column:
    """Keys that alone make two records the same organization."""
    unit = structural_unit(records, True)
    keys = F.filter("identity_keys", lambda k: F.length(F.replace(k, F.lit(" "))) >= 4)
    base = F.when(F.col("base_name") != "", F.col("base_name")).otherwise(N.text("source_name"))
    extra = F.filter(F.array(F.when(unit != "", F.concat(F.lit("opm-unit:"), unit)).otherwise(F.lit("")), N.token_key(base)), lambda k: k != "")
    return F.array_distinct(F.concat(keys, extra))


def blocked_pairs(blocks: DataFrame, most: int) -> DataFrame:
    """(key, left, right), left < right, of all blocks (key, id) with at most `most` ids."""
    blocks = blocks.distinct()
    fit = blocks.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n").between(2, most)).select("key")
    some = blocks.join(fit, "key")
    return some.select("key", F.col("id").alias("left")).join(some.select("key", F.col("id").alias("right")), "key").filter("left < right")


def subagency_code(records: DataFrame) -> Column:
    code = N.strip("opm_subagency_code") if "opm_subagency_code" in records.columns else F.lit("")
    return F.when((N.text("source") == OPM) & (N.text("source_level") == "subagency"), code).otherwise(F.lit(""))


def deterministic_merge(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, root) and the decisions of merging records by strong keys, subagencies of different codes kept apart."""
    blocks = records.select(F.col("rec_idx").alias("id"), F.explode(strong_keys(records)).alias("key"))
    info = records.select(F.col("rec_idx").alias("id"), subagency_code(records).alias("code"), F.col("normalized_parent_name").alias("parent"))
    return constrained_union(info, blocked_pairs(blocks, KEY_BLOCK))


def override_matches(records: DataFrame, overrides: DataFrame) -> DataFrame:
    """(o_idx, decision, preferred, left_ids, right_ids) of the overrides whose both names occur; overrides has o_idx."""
    own = records.select(F.col("rec_idx").alias("id"), F.explode(F.array_distinct(F.array(N.normalize_name("source_name"), N.normalize_name("base_name")))).alias("k")).filter("k <> ''")
    asked = overrides.select("o_idx", F.lower(N.strip("decision")).alias("decision"), N.strip("preferred_name").alias("preferred"), N.normalize_name("left_name").alias("lk"), N.normalize_name("right_name").alias("rk"))
    side = lambda k, out: asked.select("o_idx", F.col(k).alias("k")).join(own, "k").groupBy("o_idx").agg(F.collect_set("id").alias(out))
    return asked.join(side("lk", "left_ids"), "o_idx").join(side("rk", "right_ids"), "o_idx").drop("lk", "rk")


def ratio_bound(a: Column, b: Column) -> Column:
    """At least the indel ratio of two texts: no common subsequence has more of a character than either text has."""
    chars = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    of = lambda x, c: F.length(c) - F.length(F.replace(c, x))
    both = F.aggregate(F.array_distinct(chars(a)), F.lit(0), lambda s, x: s + F.least(of(x, a), of(x, b)).cast("int"))
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(200.0 * both / total)


def score_pairs(pairs: DataFrame, threshold: float | None = None) -> DataFrame:
    """Adds score and reasons to pairs of records a and b (structs of normalized records); for review, never for merging.

    With a threshold only pairs that reach it come back. The score never falls when the ratio rises, so pairs that stay
    below it with a bound of their ratio, found by expressions alone, are not measured.
    """
    if threshold is not None:
        likely = _scored(pairs.withColumn("ratio", ratio_bound(F.col("a.normalized_name"), F.col("b.normalized_name")))).filter(F.col("score") >= threshold)
        return score_pairs(likely.select(*pairs.columns)).filter(F.col("score") >= threshold)
    return _scored(pairs.withColumn("ratio", indel_ratio("a.normalized_name", "b.normalized_name")))


def _scored(df: DataFrame) -> DataFrame:
    """`df` of a, b and ratio with score and reasons instead of the ratio."""
    out = [c for c in df.columns if c != "ratio"]
    a, b = F.col("a"), F.col("b")
    tokens = lambda r: F.array_distinct(r["match_tokens"])
    blank = (a["normalized_name"] == "") | (b["normalized_name"] == "")
    either = F.size(F.array_union(a["match_tokens"], b["match_tokens"]))
    both = F.size(F.array_intersect(a["match_tokens"], b["match_tokens"]))
    df = df.withColumn("overlap", F.when((F.size(tokens(a)) > 0) & (F.size(tokens(b)) > 0), both / F.greatest(either, F.lit(1))).otherwise(F.lit(0.0)))
    df = df.withColumn("s0", F.greatest("ratio", F.col("overlap") * 100))
    same = lambda c: (a[c] != "") & (a[c] == b[c])
    df = df.withColumn("by_acronym", same("acronym") & (F.length(a["acronym"]) >= 3) & ((F.col("ratio") >= 60) | (F.col("overlap") >= 0.5)))
    df = df.withColumn("s1", F.when(F.col("by_acronym"), F.least(F.lit(100.0), F.col("s0") + 4)).otherwise(F.col("s0")))
    df = df.withColumn("by_domain", same("domain") & (F.col("s1") >= 60))
    df = df.withColumn("s2", F.when(F.col("by_domain"), F.least(F.lit(100.0), F.col("s1") + 4)).otherwise(F.col("s1")))
    df = df.withColumn("by_parent", same("normalized_parent_name") & (F.col("s2") >= 60))
    df = df.withColumn("s3", F.when(F.col("by_parent"), F.least(F.lit(100.0), F.col("s2") + 3)).otherwise(F.col("s2")))
    one = a["source"] == b["source"]
    score = F.when(blank, F.lit(0.0)).otherwise(F.bround(F.when(one, F.least("s3", F.lit(94.0))).otherwise(F.col("s3")), 2))
    reasons = F.array(
        F.when(F.col("ratio") >= 85, F.format_string("high_name_similarity:%.0f", F.bround("ratio", 0))),
        F.when(F.col("overlap") >= 0.6, F.format_string("high_token_overlap:%.2f", F.bround("overlap", 2))),
        F.when(F.col("by_acronym"), F.lit("same_acronym_support")),
        F.when(F.col("by_domain"), F.lit("same_domain_support")),
        F.when(F.col("by_parent"), F.lit("same_parent_support")),
        F.when(one, F.lit("same_source_separation_guard")),
    )
    reasons = F.when(blank, F.array().cast("array<string>")).otherwise(F.filter(reasons, lambda r: r.isNotNull()))
    return df.select(*out, score.alias("score"), reasons.alias("reasons"))


def token_blocks(records: DataFrame) -> DataFrame:
    token = F.explode(F.filter("match_tokens", lambda t: (F.length(t) >= 4) & ~F.array_contains(N._set(N.MEANINGFUL_WORDS), t)))
    return records.select(F.col("rec_idx").alias("id"), token.alias("key"))


def review_pairs(records: DataFrame, roots: DataFrame, kept_apart: DataFrame, threshold: float) -> DataFrame:
    """(left, right, score, reasons) of pairs in different groups that may be the same; kept_apart: (ra, rb), ra < rb."""
    pairs = blocked_pairs(token_blocks(records), TOKEN_BLOCK).select("left", "right").distinct()
    codes = records.select(F.col("rec_idx").alias("id"), subagency_code(records).alias("code")).join(roots, "id")
    codes = codes.groupBy("root").agg(F.collect_set(F.when(F.col("code") != "", F.col("code"))).alias("codes"))
    member = records.select("rec_idx", F.struct("source", "normalized_name", "match_tokens", "acronym", "domain", "normalized_parent_name").alias("r"))
    member = member.join(roots.withColumnRenamed("id", "rec_idx"), "rec_idx").join(codes, "root")
    side = lambda n, p: member.select(F.col("rec_idx").alias(n), F.col("r").alias(p), F.col("root").alias(f"r{p}"), F.col("codes").alias(f"c{p}"))
    df = pairs.join(side("left", "a"), "left").join(side("right", "b"), "right")
    conflict = (F.size("ca") > 0) & (F.size("cb") > 0) & (F.size(F.array_union("ca", "cb")) > 1)
    df = df.filter((F.col("ra") != F.col("rb")) & ~conflict & (F.col("a.source") != F.col("b.source")))
    df = df.withColumn("lo", F.least("ra", "rb")).withColumn("hi", F.greatest("ra", "rb"))
    df = df.join(kept_apart.select(F.col("ra").alias("lo"), F.col("rb").alias("hi")), ["lo", "hi"], "left_anti")
    return score_pairs(df.select("left", "right", "a", "b"), threshold).select("left", "right", "score", "reasons")


def name_counts(choice: DataFrame) -> DataFrame:
    """(nn, same_names): how many have the same normal form of `name`."""
    return choice.groupBy(N.normalize_name("name").alias("nn")).agg(F.count("*").alias("same_names"))


def _joined(c: str) -> Column:
    return F.array_join(F.sort_array(F.collect_set(F.when(N.text(c) != "", N.text(c)))), "|")


def resolve(records: DataFrame, overrides: DataFrame | None = None, threshold: float = 88) -> dict[str, DataFrame]:
    """All tables of the organizations flow from source records with rec_idx.

    organizations, organization_aliases, organization_sources, organization_candidates, organization_review_queue,
    organization_name_review, organization_relationships, organization_status.
    """
    spark = records.sparkSession
    records = reliable(normalize_records(records))
    roots, decided = deterministic_merge(records)
    none = spark.createDataFrame([], "ra long, rb long")
    manual = spark.createDataFrame([], "left long, right long, score double, reasons array<string>, decision string")
    preferred, merged, apart = spark.createDataFrame([], "root long, preferred_name string"), None, none
    if overrides is not None:
        found = reliable(override_matches(records, overrides))
        merges = found.filter(F.col("decision").isin("merge", "historical_alias"))
        members = merges.select("o_idx", "preferred", F.array_min("left_ids").alias("a"), F.explode(F.array_union("left_ids", "right_ids")).alias("b"))
        edges = roots.select(F.col("root").alias("a"), F.col("id").alias("b")).union(members.select("a", "b"))
        roots = connected_components(records.select(F.col("rec_idx").alias("id")), edges)
        in_root = members.join(roots.withColumnRenamed("id", "b"), "b")
        merged = in_root.select("root").distinct().withColumn("is_merged", F.lit(True))
        preferred = in_root.filter("preferred <> ''").groupBy("root").agg(F.max_by("preferred", "o_idx").alias("preferred_name"))
        keep = found.filter(F.col("decision") == "keep_separate")
        side = lambda c, r: keep.select("o_idx", F.explode(c).alias("id")).join(roots, "id").select("o_idx", F.col("root").alias(r)).distinct()
        two = side("left_ids", "x").join(side("right_ids", "y"), "o_idx").filter("x <> y")
        apart = reliable(two.select(F.least("x", "y").alias("ra"), F.greatest("x", "y").alias("rb")).distinct())
        known = found.filter(F.col("decision").isin("merge", "historical_alias", "keep_separate"))
        manual = known.select(F.array_min("left_ids").alias("left"), F.array_min("right_ids").alias("right"), F.lit(100.0).alias("score"), F.array(F.concat(F.lit("human_override:"), F.col("decision"))).alias("reasons"), F.concat(F.lit("manual_"), F.col("decision")).alias("decision"))
    roots = reliable(roots)
    kept = apart.select(F.col("ra").alias("root")).union(apart.select("rb")).distinct().withColumn("is_kept", F.lit(True))
    merged = merged if merged is not None else spark.createDataFrame([], "root long, is_merged boolean")
    fuzzy = review_pairs(records, roots, apart, threshold).withColumn("decision", F.lit("manual_review"))
    sure = decided.select("left", "right", F.lit(100.0).alias("score"), F.array("key").alias("reasons"), "decision")
    member = reliable(records.join(roots.withColumnRenamed("id", "rec_idx"), "rec_idx"))

    choice = reliable(choose_names(member, preferred))
    counts = name_counts(choice)
    one_id = F.concat_ws(":", N.text("source"), N.text("source_record_id"))
    is_sub = (N.text("source") == OPM) & (N.text("source_level") == "subagency")
    gathered = member.groupBy("root").agg(
        F.coalesce(F.min(F.when(is_sub, one_id)), F.min(one_id)).alias("identifier"),
        _joined("source_name").alias("aliases"), _joined("domain").alias("domains"), _joined("source").alias("sources"),
        _joined("parent_source_name").alias("parent_name_candidates"), F.count("*").alias("source_record_count"),
    )
    orgs = gathered.join(choice, "root", "left").withColumn("name", N.text("name")).withColumn("nn", N.normalize_name("name")).join(counts, "nn", "left")
    orgs = orgs.join(merged, "root", "left").join(kept, "root", "left")
    full = F.when(F.col("same_names") > 1, F.concat(F.col("name"), F.lit(" ["), F.col("identifier"), F.lit("]"))).otherwise(F.col("name"))
    status = F.when(F.coalesce("is_merged", F.lit(False)), "Reviewed merge").when(F.coalesce("is_kept", F.lit(False)), "Reviewed separate").when(F.col("source_record_count") > 1, "Deterministically resolved").otherwise("Single-source provisional")
    orgs = reliable(orgs.withColumn("external_id", N.stable_id(full)).withColumn("resolution_status", status))

    ids = reliable(member.select("rec_idx", "root", "source", "source_record_id", "source_name").join(orgs.select("root", "external_id"), "root"))
    side = lambda n, p: ids.select(F.col("rec_idx").alias(n), N.text("source").alias(f"{p}_source"), N.text("source_record_id").alias(f"{p}_source_record_id"), N.text("source_name").alias(f"{p}_name"), F.col("external_id").alias(f"{p}_canonical_external_id"))
    stages = sure.withColumn("stage", F.lit(0)).unionByName(manual.withColumn("stage", F.lit(1))).unionByName(fuzzy.withColumn("stage", F.lit(2)))
    every = reliable(stages.join(side("left", "left"), "left").join(side("right", "right"), "right").withColumn("reasons", F.array_join("reasons", "|")))
    shown = ["left_source", "left_source_record_id", "left_name", "right_source", "right_source_record_id", "right_name", "score", "reasons", "decision", "left_canonical_external_id", "right_canonical_external_id"]
    candidates = every.select(*shown)
    x, y = "left_canonical_external_id", "right_canonical_external_id"
    asked = every.filter((F.col("decision") == "manual_review") & (F.col(x) != F.col(y)))
    asked = asked.withColumn("k0", F.least(x, y)).withColumn("k1", F.greatest(x, y)).withColumn("k2", F.when(F.col("reasons").contains("distinct_opm_subagency_codes"), "codes").otherwise("fuzzy"))
    queue = first_by(asked, ["k0", "k1", "k2"], F.col("stage"), F.col("left"), F.col("right"))
    queue = reliable(queue.select(*shown, F.lit("merge / keep separate / hierarchy / historical alias").alias("review_action"), F.lit("").alias("review_notes")))
    in_queue = queue.select(F.col(x).alias("external_id")).union(queue.select(y)).distinct().withColumn("asked", F.lit(True))
    orgs = orgs.join(in_queue, "external_id", "left").withColumn("resolution_status", F.when(F.coalesce("asked", F.lit(False)), "Needs review").otherwise(F.col("resolution_status")))

    sources = member.join(orgs.select("root", F.col("external_id").alias("canonical_external_id"), "is_merged", "source_record_count"), "root")
    method = F.when(F.coalesce("is_merged", F.lit(False)), "reviewed_identity_merge").when(F.col("source_record_count") > 1, "deterministic_alias").otherwise("new_entity")
    sources = sources.withColumn("match_method", method).drop("root", "is_merged", "source_record_count")

    table = orgs.select(
        "external_id", F.col("name").alias("canonical_name"), F.col("name_source").alias("canonical_name_source"), F.col("name_record_id").alias("canonical_name_source_record_id"),
        F.col("name_as_of").alias("canonical_name_as_of"), F.col("tier").alias("canonical_name_authority_tier"), F.col("name_status").alias("canonical_name_status"),
        N.normalize_name("name").alias("normalized_name"), "aliases", "domains", "sources", "parent_name_candidates", "source_record_count", "resolution_status", F.lit("Unreviewed").alias("active_status"),
    )
    names_asked = orgs.filter("needs_review").select(
        "external_id", F.col("name").alias("chosen_name"), F.col("name_source").alias("chosen_source"), F.col("name_record_id").alias("chosen_source_record_id"), F.col("name_status").alias("canonical_name_status"),
        F.array_join("variants", "|").alias("candidate_names"), F.lit("confirm canonical name / select fallback name").alias("review_action"), F.lit("").alias("review_notes"),
    )
    return {
        "organizations": table.orderBy(F.lower("canonical_name"), "external_id"),
        "organization_aliases": alias_rows(sources).orderBy("organization_id", F.lower("alias"), "alias_type"),
        "organization_sources": sources,
        "organization_candidates": candidates.orderBy(F.desc("score"), "left_name", "right_name"),
        "organization_review_queue": queue.orderBy(F.desc("score"), "left_name", "right_name"),
        "organization_name_review": names_asked.orderBy(F.lower("chosen_name")),
        "organization_relationships": hierarchy(sources),
        "organization_status": status_rows(table),
    }


def alias_rows(sources: DataFrame) -> DataFrame:
    """Names and acronyms that sources give for an organization, with the evidence for each."""
    given = lambda c, kind: sources.select(F.col("canonical_external_id").alias("organization_id"), N.strip(c).alias("alias"), F.lit(kind).alias("alias_type"), N.text("source").alias("s"), N.text("source_record_id").alias("r"))
    rows = given("source_name", "source_name").union(given("explicit_acronym", "source_acronym")).filter("alias <> ''")
    rows = rows.groupBy("organization_id", "alias", "alias_type").agg(_joined("s").alias("sources"), _joined("r").alias("source_record_ids"), F.size(F.collect_set(F.when(F.col("s") != "", F.col("s")))).alias("source_count"))
    return rows.select(N.alias_id("organization_id", "alias").alias("alias_id"), "organization_id", "alias", N.normalize_name("alias").alias("normalized_alias"), "alias_type", "sources", "source_record_ids", "source_count")


def hierarchy(sources: DataFrame) -> DataFrame:
    """Edges from the organizations that a record names as its parent; the first record's evidence is kept.

    Both sides are first brought down to one row for each name and organization, so that what is joined is in
    proportion to the edges, however many records name one parent.
    """
    child = sources.filter("normalized_parent_name <> ''").select(F.col("rec_idx").alias("ci"), F.col("canonical_external_id").alias("child_org_id"), F.col("normalized_parent_name").alias("k"), N.text("source").alias("source"), N.text("parent_source_name").alias("evidence"))
    child = first_by(child, ["k", "child_org_id"], F.col("ci"))
    parent = sources.groupBy(F.col("normalized_name").alias("k"), F.col("canonical_external_id").alias("parent_org_id")).agg(F.min("rec_idx").alias("pi"))
    edges = first_by(child.join(parent, "k").filter("child_org_id <> parent_org_id"), ["parent_org_id", "child_org_id"], F.col("ci"), F.col("pi"))
    return edges.select("parent_org_id", "child_org_id", F.lit("parent/component").alias("relationship_type"), "source", F.lit("High").alias("confidence"), F.lit("Provisional").alias("review_status"), "evidence")


def status_rows(orgs: DataFrame) -> DataFrame:
    """Which directories confirm an organization."""
    listed = F.split("sources", r"\|")
    found = lambda p: F.exists(listed, lambda s: s.startswith(p))
    return orgs.select(
        "external_id", "canonical_name", found("USA.gov").alias("found_in_usagov"), found("Federal Register").alias("found_in_federal_register"), found("Current Federal").alias("found_in_program_inventory"),
        F.when(found("USA.gov"), "Likely current").otherwise("Needs status review").alias("suggested_status"),
        F.when(found("USA.gov"), "USA.gov presence").otherwise("No current-directory confirmation").alias("status_basis"), F.lit("Unreviewed").alias("review_status"),
    )
