"""Names of organizations and programs: normal forms, tokens, identity keys and ids. All are native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and phrases that must equal the reference's for equal results.
STOPWORDS = ["the", "of", "for", "and", "on", "in", "to", "united", "states", "u", "s"]
MEANINGFUL_WORDS = [
    "administration", "agency", "board", "bureau", "center", "centers", "commission", "committee", "corporation", "council",
    "department", "division", "office", "service", "authority", "institute", "foundation", "program", "administrative",
]
INVERTIBLE_SUFFIXES = [
    "administration for", "agency for", "authority for", "authority of", "board of", "bureau of", "center for", "center of",
    "commission of", "commission on", "committee on", "council of", "council on", "department of", "office of", "service of",
]
ORG_DESIGNATORS = [
    "administration", "agency", "authority", "board", "bureau", "center", "commission", "committee",
    "corporation", "council", "department", "division", "foundation", "institute", "office", "service",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _set(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once: a long expression that is used twice would double the plan each time."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text(c: Column | str) -> Column:
    """Null as the empty string."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def strip(c: Column | str) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(text(c), r"(?U)^\s+|\s+$", "")


def collapse(c: Column | str) -> Column:
    """Each stretch of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text(c), r"(?U)\s+", " "))


def normalize_name(c: Column | str) -> Column:
    out = F.replace(F.lower(text(c)), F.lit("&"), F.lit(" and "))
    out = F.regexp_replace(out, r"\bu\.?\s*s\.?\b", "united states")
    return F.trim(F.regexp_replace(out, "[^a-z0-9]+", " "))


def words(normalized: Column) -> Column:
    return F.filter(F.split(normalized, " "), lambda t: t != "")


def matching_tokens(c: Column | str) -> Column:
    """Words of the normal form but for stop words; order and repeats kept."""
    return F.filter(words(normalize_name(c)), lambda t: ~F.array_contains(_set(STOPWORDS), t))


def token_key(c: Column | str) -> Column:
    """The words in order, or the empty string if there are fewer than two."""
    return let(matching_tokens(c), lambda t: F.when(F.size(t) >= 2, F.concat(F.lit("tokens:"), F.array_join(F.array_sort(t), " "))).otherwise(F.lit("")))


def acronym(c: Column | str) -> Column:
    found = F.filter(F.regexp_extract_all(text(c), F.lit("[A-Za-z0-9]+"), 0), lambda w: ~F.array_contains(_set(STOPWORDS), F.lower(w)))
    return F.array_join(F.transform(found, lambda w: F.upper(F.left(w, F.lit(1)))), "")


def explicit_parenthetical_acronym(c: Column | str) -> Column:
    inner = F.regexp_replace(F.regexp_extract(text(c), r"(?U)\s*\(([^()]*)\)\s*$", 1), "[^A-Za-z0-9]", "")
    return let(inner, lambda a: F.when(F.length(a).between(2, 12) & (F.upper(a) == a), a).otherwise(F.lit("")))


def strip_parenthetical_acronym(c: Column | str) -> Column:
    cut = lambda v: strip(F.regexp_replace(v, r"(?U)\s*\([^()]*\)\s*$", ""))
    return let(text(c), lambda v: F.when(explicit_parenthetical_acronym(v) == "", strip(v)).otherwise(cut(v)))


def inverted_index_alias(c: Column | str) -> Column:
    """The name that a directory's order turned around at its first comma, or the empty string."""

    def of(left: Column, right: Column, b: Column) -> Column:
        a = words(normalize_name(left))
        inside = let(a, lambda a: (F.size(a) > 0) & (F.size(F.array_except(a, b)) == 0)) & F.arrays_overlap(b, _set(ORG_DESIGNATORS))
        return F.when((left == "") | (right == ""), F.lit("")).when(F.array_contains(_set(INVERTIBLE_SUFFIXES), F.array_join(b, " ")), F.concat_ws(" ", right, left)).when(inside, right).otherwise(F.lit(""))

    def parts(value: Column) -> Column:
        left, right = strip(F.regexp_extract(value, "(?s)^([^,]*),", 1)), strip(F.regexp_extract(value, "(?s)^[^,]*,(.*)$", 1))
        return let(left, lambda x: let(right, lambda y: let(words(normalize_name(y)), lambda b: of(x, y, b))))

    return let(text(c), lambda value: F.when(value.contains(","), parts(value)).otherwise(F.lit("")))


def _with_departments(keys: Column) -> Column:
    turned = lambda ks: F.transform(
        F.filter(ks, lambda k: k.endswith(" department") & ~k.startswith("department ") & (F.length(k) > len(" department"))),
        lambda k: F.concat(F.lit("department of "), F.trim(F.regexp_replace(k, " department$", ""))),
    )
    return let(keys, lambda ks: F.array_union(ks, turned(ks)))


def identity_keys(c: Column | str) -> Column:
    """Sorted keys under which equal organizations meet; none for a blank name."""
    base = strip_parenthetical_acronym(c)
    keys = let(base, lambda b: F.filter(F.array_distinct(F.array(normalize_name(c), normalize_name(b), normalize_name(inverted_index_alias(b)))), lambda k: k != ""))
    keys = _with_departments(keys)
    bare = lambda ks: F.transform(F.filter(ks, lambda k: k.startswith("united states ")), lambda k: F.regexp_replace(k, "^united states ", ""))
    keys = let(keys, lambda ks: F.array_union(ks, bare(ks)))
    plain = lambda ks: F.transform(ks, lambda k: F.array_join(F.filter(F.split(k, " "), lambda t: (t != "the") & (t != "")), " "))
    keys = let(keys, lambda ks: F.array_union(ks, F.filter(plain(ks), lambda k: k != "")))
    return F.array_sort(_with_departments(keys))


def moved_designator(c: Column | str) -> Column:
    """The normal form with a final "office" or "bureau" in front."""
    return F.regexp_replace(normalize_name(c), "^(.+) (office|bureau)$", "$2 of $1")


def stable_id(c: Column | str, prefix: str = "ORG") -> Column:
    stem = lambda n: F.substring(F.regexp_replace(F.regexp_replace(F.upper(n), "[^A-Z0-9]+", "_"), "^_+|_+$", ""), 1, 60)
    named = lambda n: F.coalesce(F.nullif(stem(n), F.lit("")), F.lit("UNKNOWN"))
    return let(normalize_name(c), lambda n: F.concat_ws("-", F.lit(prefix), named(n), F.upper(F.substring(F.sha1(n.cast("binary")), 1, 8))))


def alias_id(org: Column | str, alias: Column | str) -> Column:
    return F.concat(F.lit("ALIAS-"), F.upper(F.substring(F.sha1(F.concat_ws("|", text(org), normalize_name(alias)).cast("binary")), 1, 12)))


def source_key(source: Column | str, record: Column | str) -> Column:
    return F.concat(text(source), F.lit("::"), text(record))


def program_id(anchor: Column | str) -> Column:
    return F.concat(F.lit("PRG"), F.upper(F.substring(F.sha1(text(anchor).cast("binary")), 1, 10)))


def title_case(c: Column | str) -> Column:
    """Every stretch of letters with a capital; short words all in capitals stay."""
    parts = lambda v: F.regexp_extract_all(v, F.lit("[A-Za-z]+|[^A-Za-z]+"), 0)
    return let(collapse(c), lambda v: F.when(v.rlike("^[A-Z]{2,8}$"), v).otherwise(F.array_join(F.transform(parts(v), F.initcap), "")))


#: Sources by the authority that their names have, first match wins.
SOURCE_TIERS = [
    ("govinfo_govman", ["U.S. Government Manual", "US Government Manual", "GovInfo Government Manual"]),
    ("opm_fwd", ["OPM Federal Workforce Data", "OPM EHRI", "OPM FedScope"]),
    ("federal_register", ["Federal Register"]),
    ("usagov", ["USA.gov"]),
]


def source_tier(c: Column | str) -> Column:
    out = F.lit("other")
    for tier, prefixes in reversed(SOURCE_TIERS):
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | strip(c).startswith(p)
        out = F.when(hit, F.lit(tier)).otherwise(out)
    return out
