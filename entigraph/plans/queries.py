"""One query for each operator that the synthetic tables can exercise, with its SQL.

Every query reads whole tables. Arrays are joined to text, so that results compare without regard to order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import sinks
from ..functions import names as N
from ..functions import urls as U
from ..operators import graph, ordered
from ..operators import organizations as O
from ..operators import programs as K
from ..operators.naming import choose_names
from ..sources import directories as D
from ..sources import parsers as P
from ..sources import programs as G
from ..sources import reports as R
from ..sources import workforce as W

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def norm(c: str) -> str:
    out = f"replace(lower(coalesce({c}, '')), '&', ' and ')"
    out = f"regexp_replace({out}, '\\bu\\.?\\s*s\\.?\\b', 'united states', 'g')"
    return f"trim(regexp_replace({out}, '[^a-z0-9]+', ' ', 'g'))"


STOP = "['" + "', '".join(N.STOPWORDS) + "']"
TOKENS = "[x FOR x IN string_split({}, ' ') IF x <> '' AND NOT list_contains(" + STOP + ", x)]"


def tokens(c: str) -> str:
    return TOKENS.format(norm(c))


@query(f"SELECT p_partkey, {norm('p_name')} AS name FROM part UNION ALL SELECT o_orderkey, {norm('o_orderpriority')} FROM orders")
def normalize_name(spark, d):
    return t(spark, d, "part").select("p_partkey", N.normalize_name("p_name").alias("name")).union(t(spark, d, "orders").select("o_orderkey", N.normalize_name("o_orderpriority")))


@query(f"SELECT p_partkey, array_to_string({tokens('p_type')}, ' ') AS tokens, CASE WHEN len({tokens('p_type')}) >= 2 THEN 'tokens:' || array_to_string(list_sort({tokens('p_type')}), ' ') ELSE '' END AS key FROM part")
def matching_tokens(spark, d):
    return t(spark, d, "part").select("p_partkey", F.array_join(N.matching_tokens("p_type"), " ").alias("tokens"), N.token_key("p_type").alias("key"))


@query(f"SELECT p_partkey, array_to_string([upper(x[1]) FOR x IN regexp_extract_all(p_name, '[A-Za-z0-9]+') IF NOT list_contains({STOP}, lower(x))], '') AS acronym FROM part")
def acronym(spark, d):
    return t(spark, d, "part").select("p_partkey", N.acronym("p_name").alias("acronym"))


@query("""
SELECT p_partkey, CASE WHEN ok THEN inner_ ELSE '' END AS acronym, CASE WHEN ok THEN trim(regexp_replace(v, '\\s*\\([^()]*\\)\\s*$', '')) ELSE trim(v) END AS base
FROM (SELECT *, length(inner_) BETWEEN 2 AND 12 AND upper(inner_) = inner_ AS ok
      FROM (SELECT p_partkey, v, regexp_replace(regexp_extract(v, '\\s*\\(([^()]*)\\)\\s*$', 1), '[^A-Za-z0-9]', '', 'g') AS inner_
            FROM (SELECT p_partkey, p_name || ' (' || CASE WHEN p_size % 2 = 0 THEN upper(p_brand) ELSE p_brand END || ')' AS v FROM part)))
""")
def paren_acronym_strip(spark, d):
    v = F.concat("p_name", F.lit(" ("), F.when(F.col("p_size") % 2 == 0, F.upper("p_brand")).otherwise(F.col("p_brand")), F.lit(")"))
    return t(spark, d, "part").select("p_partkey", v.alias("v")).select("p_partkey", N.explicit_parenthetical_acronym("v").alias("acronym"), N.strip_parenthetical_acronym("v").alias("base"))


@query("SELECT n_nationkey, array_to_string(list_sort(['bureau of ' || lower(n_name), lower(n_name) || ' bureau of']), '|') AS keys, 'Bureau of ' || n_name AS inverted FROM (SELECT n_nationkey, trim(regexp_replace(n_name, '[^A-Za-z0-9]+', ' ', 'g')) AS n_name FROM nation)")
def identity_keys(spark, d):
    name = F.trim(F.regexp_replace("n_name", "[^A-Za-z0-9]+", " "))
    v = F.concat(name, F.lit(", Bureau of"))
    return t(spark, d, "nation").select("n_nationkey", v.alias("v")).select("n_nationkey", F.array_join(N.identity_keys("v"), "|").alias("keys"), N.inverted_index_alias("v").alias("inverted"))


@query("""
SELECT page_id, regexp_replace(host, '^www\\.', '') AS domain, split_part(url, '#', 1) AS clean, (host = 'example.net' OR host LIKE '%.example.net') AS same_site
FROM (SELECT page_id, url, lower(regexp_extract(url, '^[^:]*://([^/?#:]*)', 1)) AS host FROM pages)
""")
def url_domain(spark, d):
    return t(spark, d, "pages").select("page_id", U.domain("url").alias("domain"), U.normalized_url("url").alias("clean"), U.same_site("url", F.lit("https://example.net")).alias("same_site"))


@query(f"""
SELECT p_partkey, 'ORG-' || left(replace(upper(n), ' ', '_'), 60) || '-' || upper(left(sha1(n), 8)) AS org_id,
       'ALIAS-' || upper(left(sha1(p_brand || '|' || n), 12)) AS alias_id, 'PRG' || upper(left(sha1(p_brand || '::' || p_name), 10)) AS program_id
FROM (SELECT *, {norm('p_name')} AS n FROM part)
""")
def stable_ids(spark, d):
    return t(spark, d, "part").select("p_partkey", N.stable_id("p_name").alias("org_id"), N.alias_id("p_brand", "p_name").alias("alias_id"), N.program_id(N.source_key("p_brand", "p_name")).alias("program_id"))


@query(f"""
WITH b AS (SELECT DISTINCT p_partkey AS id, {norm("p_name")} AS key FROM part),
k AS (SELECT key FROM b GROUP BY key HAVING count(*) BETWEEN 2 AND 80)
SELECT l.key, l.id AS "left", r.id AS "right" FROM b l JOIN b r ON l.key = r.key AND l.id < r.id JOIN k ON k.key = l.key
""")
def blocked_pairs(spark, d):
    part = t(spark, d, "part")
    return O.blocked_pairs(part.select(F.col("p_partkey").alias("id"), N.normalize_name("p_name").alias("key")), O.TOKEN_BLOCK)


@query("SELECT p_partkey AS id, min(p_partkey) OVER (PARTITION BY p_name) AS root FROM part")
def entity_clusters(spark, d):
    """Parts in chains: each is linked to the next one of its name."""
    p = t(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_name")
    chain = p.withColumn("b", F.lead("id").over(Window.partitionBy("p_name").orderBy("id"))).filter("b is not null")
    return graph.connected_components(p.select("id"), chain.select(F.col("id").alias("a"), "b"))


@query("""
WITH r AS (SELECT *, trim(v) AS exact, trim(regexp_replace(v, '\\s*\\([^()]*\\)\\s*$', '')) AS shown,
             CASE source WHEN 'USA.gov' THEN 3 WHEN 'Federal Register' THEN 2 ELSE 4 END AS tier
           FROM (SELECT o_custkey AS root, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'USA.gov' WHEN 'O' THEN 'Federal Register' ELSE 'Other' END AS source,
                        'Office ' || o_orderpriority || ' (' || upper(left(o_orderpriority, 1)) || 'XY)' AS v FROM orders)),
k AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY tier, length(shown) DESC, lower(exact) DESC, o_orderkey::VARCHAR DESC) AS i FROM r)
SELECT root, shown AS name, source AS name_source, o_orderkey::VARCHAR AS name_record_id FROM k WHERE i = 1
""")
def canonical_choice(spark, d):
    """The name of each customer's orders, as if a source had named them by their priority."""
    source = F.when(F.col("o_orderstatus") == "F", "USA.gov").when(F.col("o_orderstatus") == "O", "Federal Register").otherwise("Other")
    name = F.concat(F.lit("Office "), "o_orderpriority", F.lit(" ("), F.upper(F.substring("o_orderpriority", 1, 1)), F.lit("XY)"))
    rows = t(spark, d, "orders").select(F.col("o_custkey").alias("root"), F.col("o_orderkey").alias("rec_idx"), source.alias("source"), F.col("o_orderkey").cast("string").alias("source_record_id"), name.alias("source_name"), F.lit("").alias("source_level"))
    return choose_names(rows, spark.createDataFrame([], "root long, preferred_name string")).select("root", "name", "name_source", "name_record_id")


@query("SELECT p_name, string_agg(DISTINCT p_brand, '|' ORDER BY p_brand) AS brands, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS types, count(*) AS n FROM part GROUP BY p_name")
def cluster_rollup(spark, d):
    return t(spark, d, "part").groupBy("p_name").agg(O._joined("p_brand").alias("brands"), O._joined("p_type").alias("types"), F.count("*").alias("n"))


def _kept(order: str) -> str:
    return f"SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS r FROM events) WHERE r = 1"


@query(_kept("event_id"))
def keep_first(spark, d):
    return ordered.keep_first(t(spark, d, "events").select("user_id", "event_id"), ["user_id"], "event_id")


@query(_kept("event_id DESC"))
def keep_last(spark, d):
    return ordered.keep_last(t(spark, d, "events").select("user_id", "event_id"), ["user_id"], "event_id")


@query("SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY length(text) DESC, doc_id) AS r FROM documents) WHERE r = 1")
def keep_longest(spark, d):
    return ordered.keep_longest(t(spark, d, "documents").select("source", "doc_id", "text"), ["source"], "text", "doc_id").select("source", "doc_id")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_type || event_id::VARCHAR END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS last_purchase FROM events")
def fill_down(spark, d):
    e = t(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_type") == "purchase", F.concat("event_type", F.col("event_id").cast("string"))).otherwise("").alias("v"))
    return ordered.fill_down(e, ["user_id"], "event_id", "v", "last_purchase").select("event_id", "last_purchase")


@query("""
SELECT 'R' || r_regionkey AS parent_org_id, 'N' || n_nationkey AS child_org_id, 'parent/component' AS relationship_type, 'Federal Register' AS source, 'High' AS confidence, 'Provisional' AS review_status, r_name AS evidence
FROM nation JOIN region ON r_regionkey = n_regionkey
""")
def hierarchy_edges(spark, d):
    """Nations as records that name their region as parent."""
    region, nation = t(spark, d, "region"), t(spark, d, "nation")
    rec = lambda df, idx, key, name, parent: df.select(idx.alias("rec_idx"), key.alias("canonical_external_id"), N.normalize_name(name).alias("normalized_name"), N.normalize_name(parent).alias("normalized_parent_name"), F.lit("Federal Register").alias("source"), parent.alias("parent_source_name"))
    nations = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))  # region: 5 rows
    rows = rec(region, F.col("r_regionkey"), F.concat(F.lit("R"), F.col("r_regionkey").cast("string")), F.col("r_name"), F.lit(""))
    return O.hierarchy(rows.union(rec(nations, F.col("n_nationkey") + 100, F.concat(F.lit("N"), F.col("n_nationkey").cast("string")), F.col("n_name"), F.col("r_name"))))


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def customers_without_urgent_orders(spark, d):
    return ordered.missing_from(t(spark, d, "customer").select("c_custkey", "c_name"), t(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


@query("SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey)")
def parts_without_lines(spark, d):
    return ordered.missing_from(t(spark, d, "part").select("p_partkey"), t(spark, d, "lineitem").withColumnRenamed("l_partkey", "p_partkey"), ["p_partkey"])


@query("""
WITH s AS (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS u, bool_or(o_orderstatus = 'O') AS f, bool_or(o_orderstatus = 'P') AS c FROM orders GROUP BY o_custkey)
SELECT o_custkey::VARCHAR AS external_id, u AS found_in_usagov, f AS found_in_federal_register, c AS found_in_program_inventory,
       CASE WHEN u THEN 'Likely current' ELSE 'Needs status review' END AS suggested_status,
       CASE WHEN u THEN 'USA.gov presence' ELSE 'No current-directory confirmation' END AS status_basis, 'Unreviewed' AS review_status FROM s
""")
def status_flags(spark, d):
    """Customers as organizations, in the sources that the states of their orders stand for."""
    source = F.when(F.col("o_orderstatus") == "F", "USA.gov Agency Index").when(F.col("o_orderstatus") == "O", "Federal Register Agencies API").otherwise("Current Federal Program Inventory")
    orgs = t(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("external_id")).agg(F.array_join(F.sort_array(F.collect_set(source)), "|").alias("sources"))
    return O.status_rows(orgs.withColumn("canonical_name", F.col("external_id"))).drop("canonical_name")


@query("""
SELECT n_nationkey, i AS seq, regexp_extract_all(v, '(\\d+) U\\.S\\.C\\. (\\d+)', 1)[i] AS title, regexp_extract_all(v, '(\\d+) U\\.S\\.C\\. (\\d+)', 2)[i] AS section
FROM (SELECT n_nationkey, n_nationkey::VARCHAR || ' U.S.C. ' || (n_nationkey * 7 + 1)::VARCHAR || '; 42 U.S.C. ' || (n_nationkey + 100)::VARCHAR AS v FROM nation), unnest([1, 2]) u(i)
""")
def authority_citations(spark, d):
    k = F.col("n_nationkey")
    v = F.concat(k.cast("string"), F.lit(" U.S.C. "), (k * 7 + 1).cast("string"), F.lit("; 42 U.S.C. "), (k + 100).cast("string"))
    out = P.parse_authorities(t(spark, d, "nation").select("n_nationkey", v.alias("v")), "v")
    return out.select("n_nationkey", F.col("authority_sequence").alias("seq"), F.col("usc_title").alias("title"), F.col("usc_section").alias("section"))


@query("""SELECT page_id, count(*) AS n, string_agg(href, '|' ORDER BY href) AS hrefs FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages) GROUP BY page_id""")
def link_extract(spark, d):
    links = P.links(t(spark, d, "pages").select("page_id", "html"), "html")
    return links.groupBy("page_id").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("href")), "|").alias("hrefs"))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(' ' || replace(v, ' ', '  ') || ' ', '[^0-9]((?:19|20)[0-9]{2})[^0-9]', 1))), '|') AS years FROM (SELECT doc_id, 'FYxx ' || (1900 + doc_id % 200)::VARCHAR || ' and ' || (doc_id + 1990)::VARCHAR AS v FROM documents)")
def year_candidates(spark, d):
    v = F.concat(F.lit("FYxx "), (1900 + F.col("doc_id") % 200).cast("string"), F.lit(" and "), (F.col("doc_id") + 1990).cast("string"))
    return t(spark, d, "documents").select("doc_id", F.array_join(U.year_candidates(v), "|").alias("years"))


@query(f"""
SELECT page_id, CASE {" ".join(f"WHEN regexp_matches(v, '(?i){pattern}') THEN '{kind}'" for kind, pattern in R.TYPES)} ELSE '' END AS kind
FROM (SELECT page_id, regexp_replace(label || ' ' || regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1), '[-_+/]+', ' ', 'g') AS v
      FROM (SELECT page_id, url, CASE page_id % 5 WHEN 0 THEN 'Annual Performance Report' WHEN 1 THEN 'Strategic plan' WHEN 2 THEN 'performance plan and report' WHEN 3 THEN 'Annual-Report' ELSE 'News' END AS label FROM pages))
""")
def report_type(spark, d):
    labels = ["Annual Performance Report", "Strategic plan", "performance plan and report", "Annual-Report", "News"]
    label = F.get(F.array(*map(F.lit, labels)), (F.col("page_id") % 5).cast("int"))
    return t(spark, d, "pages").select("page_id", R.report_type(label, "url").alias("kind"))


@query("""
SELECT p_partkey, 'The purpose of it is ' || p_brand || '. They shall establish ' || p_type || ';' AS purpose, 'statutory_signal_text' AS method FROM part WHERE p_size % 2 = 0
UNION ALL SELECT p_partkey, '', 'section_found_no_purpose_signal' FROM part WHERE p_size % 2 = 1
""")
def purpose_candidate(spark, d):
    told = F.concat(F.lit("The purpose of it is "), "p_brand", F.lit(". Nothing else.  They shall  establish "), "p_type", F.lit("; Done."))
    v = F.when(F.col("p_size") % 2 == 0, told).otherwise(F.concat("p_brand", F.lit(". Nothing else.")))
    return t(spark, d, "part").select("p_partkey", G.purpose_candidate(v).alias("p")).select("p_partkey", "p.purpose", "p.method")


@query("""
SELECT 'department:' || r_name AS source_record_id, r_name AS source_name, '' AS parent_source_name, 'department' AS source_level FROM region
UNION ALL SELECT DISTINCT 'agency:' || r_name || ':' || n_name, n_name, r_name, 'agency/component' FROM nation JOIN region ON r_regionkey = n_regionkey
""")
def inventory_records(spark, d):
    pairs = t(spark, d, "region").join(t(spark, d, "nation"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return D.inventory(pairs.select(F.col("r_name").alias("Department"), F.col("n_name").alias("Agency"))).select("source_record_id", "source_name", "parent_source_name", "source_level")


@query("SELECT n_nationkey, 'Department of the ' || w(r_name) AS department, w(n_name) AS agency FROM nation JOIN region ON r_regionkey = n_regionkey".replace("w(r_name)", "{0}").replace("w(n_name)", "{1}").format(
    *["CASE WHEN regexp_full_match({0}, '[A-Z]{{2,8}}') THEN {0} ELSE array_to_string([upper(x[1]) || lower(x[2:]) FOR x IN string_split({0}, ' ')], ' ') END".format(c) for c in ("r_name", "n_name")]
))
def agency_labels(spark, d):
    pairs = t(spark, d, "nation").join(F.broadcast(t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # region: 5 rows
    label = F.concat("n_name", F.lit(" (XY), "), "r_name", F.lit(", DEPARTMENT OF THE"))
    return pairs.select("n_nationkey", G.agency_parts(label).alias("p")).select("n_nationkey", "p.department", "p.agency")


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct(['P.1-' || p_partkey::VARCHAR, 'P.1-x_' || p_size::VARCHAR])), '|') AS ids FROM part")
def granule_ids(spark, d):
    xml = F.concat(F.lit("<a id='P.1-x_"), F.col("p_size").cast("string"), F.lit("'>P.1-"), F.col("p_partkey").cast("string"), F.lit(" P.1-"), F.col("p_partkey").cast("string"), F.lit(" PX1-9</a>"))
    return t(spark, d, "part").select("p_partkey", F.array_join(D.granules_from_xml(xml, F.lit("P.1")), "|").alias("ids"))


@query("SELECT 'S' AS source, s_suppkey::VARCHAR AS source_record_id, s_name AS source_name, 'u' AS source_url FROM supplier UNION ALL SELECT 'S', c_custkey::VARCHAR, c_name, 'u' FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def statutory_append(spark, d):
    one = lambda n, k, name: t(spark, d, n).select(F.lit("S").alias("source"), F.col(k).cast("string").alias("source_record_id"), F.col(name).alias("source_name"), F.lit("u").alias("source_url"))
    return D.append_statutory(one("supplier", "s_suppkey", "s_name"), one("customer", "c_custkey", "c_name"))


@query("SELECT s_suppkey AS id, s_name AS name, s_acctbal AS acctbal, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer".replace("NULL::VARCHAR", "''"))
def hetero_union(spark, d):
    s = t(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    return ordered.union_sources(s, t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment")))


@query("SELECT 'orders' AS name, count(*) AS rows FROM orders UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'regions of no name', 0")
def summary_counts(spark, d):
    return sinks.row_counts({"orders": t(spark, d, "orders"), "documents": t(spark, d, "documents"), "regions of no name": t(spark, d, "region").filter("r_name is null")})


@query(f"SELECT {norm('p_name')} AS nn, count(*) AS same_names FROM part GROUP BY 1 HAVING count(*) > 1")
def name_collisions(spark, d):
    return O.name_counts(t(spark, d, "part").select("p_partkey", F.col("p_name").alias("name"))).filter("same_names > 1")


@query("""
SELECT event_id::VARCHAR AS source_record_id, coalesce(json_extract_string(props, '$.page'), '') AS source_name, event_type AS source_status,
       'E' || (user_id % 7)::VARCHAR AS department_source_name, CASE WHEN event_id % 3 = 0 THEN 'http://w/' || event_id::VARCHAR ELSE 'u' END AS source_url FROM events
""")
def json_flatten(spark, d):
    """Events as listings of the programs API, ten to a page."""
    org = F.struct(F.concat(F.lit("E"), (F.col("user_id") % 7).cast("string")).alias("department"))
    item = F.struct(
        F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("assistanceListingId"), F.col("event_id").cast("string").alias("programId"), F.get_json_object("props", "$.page").alias("title"),
        F.col("event_type").alias("status"), org.alias("federalOrganization"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("http://w/"), F.col("event_id").cast("string"))).alias("programWebPage"),
    )
    pages = t(spark, d, "events").groupBy((F.col("event_id") / 10).cast("long").alias("page")).agg(F.to_json(F.struct(F.collect_list(item).alias("assistanceListingsData"))).alias("payload"))
    found, _, _ = G.listings_from_json(pages.select("payload", F.lit("u").alias("source_url")))
    return found.select("source_record_id", "source_name", "source_status", "department_source_name", "source_url")


@query("""
WITH n AS (SELECT r_name, n_name, 'SX' || right('00' || n_nationkey::VARCHAR, 2) AS code, s_suppkey, s_name FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey),
o AS (SELECT DISTINCT ON (n_name) * FROM n ORDER BY n_name, s_suppkey DESC)
SELECT 'department' AS source_level, 'department:' || regexp_replace(lower(r_name), '[^a-z0-9]+', '-', 'g') AS source_record_id, r_name AS source_name, '' AS parent_source_name, '' AS opm_subagency_code FROM n WHERE r_name <> 'ASIA' GROUP BY r_name
UNION ALL SELECT 'agency', 'agency:' || regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), n_name, CASE WHEN r_name = 'ASIA' THEN '' ELSE r_name END, '' FROM n GROUP BY n_name, r_name
UNION ALL SELECT 'subagency', 'subagency:' || code, s_name, n_name, code FROM o
""")
def workforce_records(spark, d):
    """Regions, nations and suppliers as departments, agencies and their subagencies; one region only gathers others."""
    nations = t(spark, d, "nation").join(F.broadcast(t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # region: 5 rows
    code = F.concat(F.lit("SX"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    table = t(spark, d, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("rec_idx"), F.when(F.col("r_name") == "ASIA", "Non-CFO Act Agency").otherwise(F.col("r_name")).alias("Department Name"), F.col("n_name").alias("agency"),
        F.concat(code, F.lit(" - "), "s_name").alias("AGYSUBT"), code.alias("Agency_SubElement_Code"),
    )
    return W.workforce_records(table).select("source_level", "source_record_id", "source_name", "parent_source_name", "opm_subagency_code")


@query("""
SELECT p_partkey::VARCHAR AS source_record_id, CASE WHEN p_size % 3 = 0 THEN 'N' || n_nationkey WHEN p_size % 3 = 1 THEN 'R' || r_regionkey ELSE '' END AS organization_id
FROM part JOIN nation ON n_nationkey = p_partkey % 25 JOIN region ON r_regionkey = n_regionkey
""")
def program_organizations(spark, d):
    """Parts as programs of nations, of their regions, or of nobody that is known."""
    region, nation = t(spark, d, "region"), t(spark, d, "nation")
    nations = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))  # region: 5 rows
    key = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    orgs = region.select(key("R", "r_regionkey").alias("external_id"), F.col("r_name").alias("canonical_name")).union(nation.select(key("N", "n_nationkey"), "n_name"))
    sources = nations.select(key("N", "n_nationkey").alias("canonical_external_id"), F.col("n_name").alias("source_name"), F.col("r_name").alias("parent_source_name"))
    index = K.organization_index(orgs, spark.createDataFrame([], "organization_id string, alias string"), sources)
    size = F.col("p_size") % 3
    records = t(spark, d, "part").join(F.broadcast(nations), F.col("p_partkey") % 25 == F.col("n_nationkey")).select(  # 25 rows
        F.col("p_partkey").alias("rec_idx"), F.lit("supplemental").alias("source_key"), F.col("p_partkey").cast("string").alias("source_record_id"), F.col("p_name").alias("source_name"),
        F.lit("").alias("office_source_name"), F.when(size == 0, F.col("n_name")).otherwise("").alias("agency_source_name"), F.when(size == 2, "Nobody").otherwise(F.col("r_name")).alias("department_source_name"),
    )
    return K.map_organizations(records, index)[0].select("source_record_id", "organization_id")


@query("""
WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"[^>]*>[^<]*</a>', 1)) AS href, generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"[^>]*>[^<]*</a>', 1), 1) AS i FROM pages),
t AS (SELECT page_id, i, url, CASE WHEN href LIKE 'http%' THEN href ELSE regexp_extract(url, '^[^:]*://[^/]*', 0) || href END AS target FROM l WHERE href LIKE 'http%' OR href LIKE '/%')
SELECT page_id AS site, count(DISTINCT split_part(target, '#', 1)) AS reports FROM t
WHERE regexp_extract(target, '://([^/?#:]*)', 1) = regexp_extract(url, '://([^/?#:]*)', 1) GROUP BY page_id
""")
def report_links(spark, d):
    """Pages as sites of one page each, whose links are all called annual reports."""
    pages = t(spark, d, "pages").select(F.col("page_id").alias("site"), F.col("url").alias("home"), F.lit(0).alias("depth"), F.lit(1).alias("place"), F.col("url").alias("final"), F.col("html").cast("binary").alias("body"))
    linked = R.linked(pages).withColumn("label", F.lit("Annual Report"))
    return R.report_candidates(linked).groupBy("site").agg(F.count("*").alias("reports"))


@query(f"""
WITH RECURSIVE p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS k FROM part) WHERE k = 1),
v AS (SELECT p_partkey AS id, p_partkey % 2 AS source, p_name || ' ' || p_type || ' works' AS name, lower(replace(p_brand, '#', '')) || '.com' AS domain, {norm("p_type")} AS parent FROM p),
r AS (SELECT *, {norm("name")} AS n, {tokens("name")} AS t, array_to_string([upper(x[1]) FOR x IN regexp_extract_all(name, '[A-Za-z0-9]+') IF NOT list_contains({STOP}, lower(x))], '') AS ac FROM v),
b AS (SELECT DISTINCT id, x AS key FROM (SELECT id, unnest(t) AS x FROM r) WHERE length(x) >= 4 AND NOT list_contains(['{"', '".join(N.MEANINGFUL_WORDS)}'], x)),
f AS (SELECT key FROM b GROUP BY key HAVING count(*) BETWEEN 2 AND 80),
pair AS (SELECT DISTINCT x.id AS l, y.id AS r FROM b x JOIN b y USING (key) JOIN f USING (key) WHERE x.id < y.id),
lcs(l, r, a, b, i, best) AS (
  SELECT pair.l, pair.r, x.n, y.n, 0, [0 FOR j IN range(length(y.n) + 1)] FROM pair JOIN r x ON x.id = pair.l JOIN r y ON y.id = pair.r WHERE x.source <> y.source
  UNION ALL SELECT l, r, a, b, i + 1, [0] || [greatest(best[j + 1], coalesce(list_max([best[k] + 1 FOR k IN range(1, j + 1) IF b[k] = a[i + 1]]), 0)) FOR j IN range(1, length(b) + 1)] FROM lcs WHERE i < length(a)),
s AS (SELECT l, r, 200.0::DOUBLE * best[-1] / (length(a) + length(b)) AS ratio FROM lcs WHERE i = length(a)),
o AS (SELECT s.*, x.ac = y.ac AND length(x.ac) >= 3 AS same_ac, x.domain = y.domain AS same_domain, x.parent = y.parent AS same_parent,
        len(list_intersect(x.t, y.t))::DOUBLE / len(list_distinct(x.t || y.t)) AS overlap FROM s JOIN r x ON x.id = s.l JOIN r y ON y.id = s.r),
a AS (SELECT *, greatest(ratio, overlap * 100) AS s0, same_ac AND (ratio >= 60 OR overlap >= 0.5) AS by_ac FROM o),
d AS (SELECT *, CASE WHEN by_ac THEN least(100.0, s0 + 4) ELSE s0 END AS s1 FROM a),
e AS (SELECT *, same_domain AND s1 >= 60 AS by_domain, CASE WHEN same_domain AND s1 >= 60 THEN least(100.0, s1 + 4) ELSE s1 END AS s2 FROM d),
g AS (SELECT *, same_parent AND s2 >= 60 AS by_parent, round_even(CASE WHEN same_parent AND s2 >= 60 THEN least(100.0, s2 + 3) ELSE s2 END, 2) AS score FROM e)
SELECT l AS "left", r AS "right", score, concat_ws('|', CASE WHEN ratio >= 85 THEN 'high_name_similarity:' || round_even(ratio, 0)::INT END,
         CASE WHEN overlap >= 0.6 THEN 'high_token_overlap:' || printf('%.2f', round_even(overlap, 2)) END, CASE WHEN by_ac THEN 'same_acronym_support' END,
         CASE WHEN by_domain THEN 'same_domain_support' END, CASE WHEN by_parent THEN 'same_parent_support' END) AS reasons FROM g WHERE score >= 60
""")
def fuzzy_review(spark, d):
    """Scored review candidates among the first part of each name, called by its name and type, with a site and a parent."""
    p = ordered.first_by(t(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type"), ["p_name"], F.col("p_partkey"))
    r = p.select(
        F.col("p_partkey").alias("rec_idx"), F.concat(F.lit("S"), (F.col("p_partkey") % 2).cast("string")).alias("source"), F.concat_ws(" ", "p_name", "p_type", F.lit("works")).alias("source_name"),
        F.concat(F.lit("https://www."), F.replace("p_brand", F.lit("#"), F.lit("")), F.lit(".com/")).alias("website"), F.col("p_type").alias("parent_source_name"), F.lit("").alias("source_level"),
    )
    r = O.normalize_records(r)
    return O.review_pairs(r, r.select(F.col("rec_idx").alias("id"), F.col("rec_idx").alias("root")), spark.createDataFrame([], "ra long, rb long"), 60).withColumn("reasons", F.array_join("reasons", "|"))


@query(f"""
WITH r AS (SELECT 'USA.gov' AS source, r_regionkey::VARCHAR AS id, r_name AS name, '' AS parent FROM region UNION ALL SELECT 'Federal Register', n_nationkey::VARCHAR, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey
      UNION ALL SELECT 'Current Federal', s_suppkey::VARCHAR, s_name, '' FROM supplier UNION ALL SELECT 'Parts', p_partkey::VARCHAR, p_name, '' FROM part),
k AS (SELECT *, {norm("name")} AS n, source || ':' || id AS ident, count(*) OVER (PARTITION BY {norm("name")}) AS c FROM r),
g AS (SELECT CASE WHEN c BETWEEN 2 AND {O.KEY_BLOCK} THEN n ELSE ident END AS grp, min(n) AS n, min(ident) AS ident, arg_min(name, CASE source WHEN 'Federal Register' THEN 0 WHEN 'USA.gov' THEN 1 ELSE 2 END) AS name,
        arg_min(source, CASE source WHEN 'Federal Register' THEN 0 WHEN 'USA.gov' THEN 1 ELSE 2 END) AS first_source, string_agg(DISTINCT name, '|' ORDER BY name) AS aliases, string_agg(DISTINCT source, '|' ORDER BY source) AS sources,
        coalesce(string_agg(DISTINCT parent, '|' ORDER BY parent) FILTER (WHERE parent <> ''), '') AS parents, count(*) AS records FROM k GROUP BY grp),
f AS (SELECT *, {norm("CASE WHEN count(*) OVER (PARTITION BY n) > 1 THEN name || ' [' || ident || ']' ELSE name END")} AS shown FROM g)
SELECT 'ORG-' || left(replace(upper(shown), ' ', '_'), 60) || '-' || upper(left(sha1(shown), 8)) AS external_id, name AS canonical_name, first_source AS canonical_name_source, '' AS canonical_name_as_of,
       CASE first_source WHEN 'USA.gov' THEN 'usagov' WHEN 'Federal Register' THEN 'federal_register' ELSE 'other' END AS canonical_name_authority_tier, 'Fallback source hierarchy' AS canonical_name_status, n AS normalized_name,
       aliases, '' AS domains, sources, parents AS parent_name_candidates, records AS source_record_count, CASE WHEN records > 1 THEN 'Deterministically resolved' ELSE 'Single-source provisional' END AS resolution_status, 'Unreviewed' AS active_status FROM f
""")
def organizations(spark, d):
    """The organizations flow over regions, nations, suppliers and parts as source records. No two of these tables have a
    word of a name in common, so that no pair is left for review."""
    return flagship(spark, d)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    rec = lambda df, src, key, name, parent: df.select(F.lit(src).alias("source"), F.col(key).cast("string").alias("source_record_id"), F.col(name).alias("source_name"), F.lit("").alias("website"), parent.alias("parent_source_name"), F.lit("").alias("source_level"))
    nation, region = t(spark, d, "nation"), t(spark, d, "region")
    nations = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rec(region, "USA.gov", "r_regionkey", "r_name", F.lit("")).union(rec(nations, "Federal Register", "n_nationkey", "n_name", F.col("r_name"))).union(rec(t(spark, d, "supplier"), "Current Federal", "s_suppkey", "s_name", F.lit(""))).union(rec(t(spark, d, "part"), "Parts", "p_partkey", "p_name", F.lit("")))
    code = F.when(F.col("source") == "USA.gov", 0).when(F.col("source") == "Federal Register", 1).when(F.col("source") == "Current Federal", 2).otherwise(3)
    rows = rows.withColumn("rec_idx", F.col("source_record_id").cast("long") * 4 + code)
    return O.resolve(rows)["organizations"].drop("canonical_name_source_record_id")
