"""Downloads of the sources: what to ask for, in which order, and what to fall back on.

Every answer is kept in a raw folder that driver and executors share, as a row of a table (address, outcome, body, digest) or,
where a body is a table itself, as a file. Addresses that do not depend on each other's answers are read as one
table. The driver sees counts, states and paths, never bodies, but for the few answers that only tell what to ask for next.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterable
from urllib.parse import quote, urlencode, urljoin

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names as N
from ..functions import urls as U
from . import directories as D
from . import programs as G
from . import web
from . import workforce as W
from .paged import Paging, pages
from .parsers import links
from .web import Fetch, read_url

REQUEST = "at long, url string, site long, policy string, budget long"


class DownloadError(RuntimeError):
    """A source gave nothing that could be used."""


def asked(spark: SparkSession, urls: Iterable[str]) -> DataFrame:
    """Requests for the addresses, each by itself, numbered by `at`."""
    return spark.createDataFrame([(i, u, i, None, None) for i, u in enumerate(urls)], REQUEST)


def answers(requests: DataFrame, fetch: Fetch, folder: str, max_bytes: int = web.DOCUMENT_BYTES, workers: int = 8) -> DataFrame:
    """The answers of requests as a table in the folder: the request, outcome, error, final, kind, body, sha256."""
    got = web.fetched(requests.repartition(workers, "site").sortWithinPartitions("site", "at"), fetch, max_bytes)
    return web.written(got.withColumn("sha256", F.coalesce(F.sha2("body", 256), F.lit(""))), folder)


@F.pandas_udf(T.StringType())
def _text(bodies: pd.Series) -> pd.Series:  # decode() of the engine refuses wrong bytes
    return bodies.map(lambda b: None if b is None else bytes(b).decode("utf-8-sig", "replace"))


def stored(spark: SparkSession, files: list[tuple[str, str]], fetch: Fetch, folder: str, convert: Callable[[bytes], bytes] = bytes, max_bytes: int = web.TABLE_BYTES) -> dict[str, str]:
    """Paths by name of the (url, name) files that could be read, kept under their names in the folder.

    Bodies are read and kept by one task each and are in no table, as they may be large. convert(body) gives what is kept.
    """
    save = web.Folder(folder)

    def run(batches):
        for batch in batches:
            told = []
            for url, name in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                try:
                    told.append((name, save(name, convert(web.Answer(*fetch(url, max_bytes=max_bytes)).body)), None))
                except Exception as e:  # noqa: BLE001  the caller falls back
                    told.append((name, None, f"{type(e).__name__}:{e}"))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in told], pa.string()) for i in range(3)], ["name", "path", "error"])

    out = spark.createDataFrame(files, "url string, name string").repartition(max(1, len(files)), "name").mapInArrow(run, "name string, path string, error string")
    return {r["name"]: r["path"] for r in out.collect() if r["path"]}  # a row for each file asked for


def failures(got: DataFrame, parsed: DataFrame | None = None, url: str = "url") -> DataFrame:
    """(url, reason) of the answers that could not be read, and of those without a row in `parsed` (a table with url)."""
    bad = got.filter("outcome <> 'read'").select("url", F.coalesce("error", "outcome").alias("reason"))
    if parsed is None:
        return bad
    empty = got.filter("outcome = 'read'").select("url").join(parsed.select(F.col(url).alias("url")).distinct(), "url", "left_anti")
    return bad.union(empty.withColumn("reason", F.lit("no records parsed")))


# directories


def agency_index(spark: SparkSession, base_url: str, letters: str, raw: str, fetch: Fetch = read_url) -> tuple[DataFrame, DataFrame]:
    """(records, failures) of the index: its first page and one for each letter."""
    got = answers(asked(spark, [base_url, *(f"{base_url}/{x}" for x in letters)]), fetch, f"{raw}/usagov")
    pages = got.filter("outcome = 'read'").select(F.col("at").alias("page_no"), "url", _text("body").alias("html"))
    return D.agency_index(pages), failures(got, D.index_rows(pages))


def agency_list(spark: SparkSession, endpoint: str, raw: str, fetch: Fetch = read_url) -> DataFrame:
    """Records of the nested list that the endpoint gives."""
    got = answers(asked(spark, [endpoint]), fetch, f"{raw}/federal_register")
    if bad := failures(got).first():
        raise DownloadError(f"{endpoint}: {bad['reason']}")
    return D.agency_list(got.select(_text("body").alias("payload")))


TOTALS = ("count", "totalCount", "total", "numberOfRecords")  # fixed value: where an answer tells how many there are
MOST_GRANULES = 10_000


def paged_list(spark: SparkSession, paging: Paging, folder: str, fetch: Fetch) -> DataFrame:
    """(at, url, sha256, payload) of all pages, kept in the folder."""
    got = pages(spark, paging, fetch).withColumn("sha256", F.sha2("body", 256))
    return web.written(got, folder).select("at", "url", "sha256", _text("body").alias("payload"))


def listed_granules(spark: SparkSession, package: str, api: str, key: str, raw: str, fetch: Fetch = read_url, page_size: int = 100) -> DataFrame:
    """(at, granule_id) of a package from its paged list, in its order, each once."""
    query = urlencode({"pageSize": page_size, "api_key": key}).replace("{", "{{").replace("}", "}}")
    address = f"{api.rstrip('/')}/packages/{quote(package)}/granules?offset={{}}&{query}"
    try:
        listed = paged_list(spark, Paging(address, size=page_size, totals=TOTALS, most=MOST_GRANULES), f"{raw}/granules", fetch)
    except Exception as e:  # whatever a page failed by
        told = str(e)
        if "more than" in told:
            raise DownloadError(f"{package} has more than {MOST_GRANULES} granules") from e
        raise DownloadError("the list of granules refused the key or the rate" if re.search(r"\b(401|403|429)\b", told) else f"the list of granules failed: {told[-500:]}") from e
    found = D.granules_from_api(listed.select(F.col("at").alias("page"), "payload"))
    first = found.groupBy("granule_id").agg(F.min(F.struct("page", "position")).alias("p"))
    return web.written(numbered(first.select("p", "granule_id"), "p"), f"{raw}/granule-ids")


def numbered(df: DataFrame, by: str) -> DataFrame:
    """`df` with `at` instead of `by`: numbers in its order."""
    return df.orderBy(by).withColumn("at", F.monotonically_increasing_id()).drop(by)


def manual(spark: SparkSession, package: str, xml_url: str, published: str, raw: str, fetch: Fetch = read_url, api: str = "https://api.govinfo.gov", key: str = "DEMO_KEY", page_size: int = 100, workers: int = 12) -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    """(records, audit table, failures, how the ids were found) of an edition of the manual.

    Ids come from the paged list, else from the package's XML, else from its context page.
    """
    raw = f"{raw}/govinfo/{package}"
    details = f"https://www.govinfo.gov/app/details/{package}"
    edition = answers(asked(spark, [xml_url]), fetch, f"{raw}/edition", web.TABLE_BYTES)
    if bad := failures(edition).first():
        raise DownloadError(f"{xml_url}: {bad['reason']}")
    digest, error = edition.first()["sha256"], ""
    named = lambda got, by: numbered(got.select(F.posexplode(by(_text("body"), F.lit(package))).alias("p", "granule_id")), "p")
    method, ids, n = "govinfo_api", None, 0
    try:
        ids = listed_granules(spark, package, api, key, raw, fetch, page_size)
        n = ids.count()
    except DownloadError as e:
        error = str(e)
    if not n:
        method, ids = "package_xml_regex", named(edition, D.granules_from_xml)
        n = ids.count()
    if not n:
        method, ids = "context_html_fallback", named(answers(asked(spark, [f"{details}/context"]), fetch, f"{raw}/context"), D.granules_from_page)
        n = ids.count()
    found = {"package_id": package, "method": method, "granule_count": n, "api_error": error}
    if not n:
        raise DownloadError(f"no granules of {package}: {found}")
    one = lambda kind: F.lit(None).cast(kind)
    requests = ids.select("at", F.concat(F.lit(f"{details}/"), "granule_id").alias("url"), F.col("at").alias("site"), one("string").alias("policy"), one("long").alias("budget"), "granule_id")
    got = answers(requests, fetch, f"{raw}/details", workers=workers)
    pages = got.filter("outcome = 'read'").select("at", F.lit(package).alias("package_id"), "granule_id", F.lit(published).alias("publication_date"), _text("body").alias("html"))
    audit = D.manual_details(pages).withColumn("package_xml_sha256", F.lit(digest))
    records = D.manual_records(audit, published).withColumn("govinfo_package_xml_sha256", F.lit(digest))
    return records, audit.drop("at"), failures(got), found


def workforce(spark: SparkSession, files_api: str, download_url: str, raw: str, fetch: Fetch = read_url) -> DataFrame:
    """Records of the newest workforce table that the list of files names."""
    got = answers(asked(spark, [f"{files_api}?current=true"]), fetch, f"{raw}/opm_fwd/files")
    if bad := failures(got).first():
        raise DownloadError(f"{files_api}: {bad['reason']}")
    listed = W.listed_files(got.select(_text("body").alias("p")).first()["p"])
    if not listed:
        raise DownloadError("the list of workforce files is empty")
    top = W.newest_file(spark.createDataFrame(listed, "captured string, year string, month string, version string")).first()
    url, name = f"{download_url.rstrip('/')}/{top['year']}/{top['month']}/{top['version']}/download", f"employment_{top['year']}_{top['month']}_v{top['version']}.parquet"
    paths = stored(spark, [(url, name)], fetch, f"{raw}/opm_fwd")
    if name not in paths:
        raise DownloadError(f"{url} could not be read")
    table = spark.read.parquet(paths[name])
    return W.workforce_records(table.withColumn("rec_idx", F.monotonically_increasing_id()), top["data_as_of"], url)


# programs


def utf8(body: bytes) -> bytes:
    return G.decoded(body).encode()


def listings(spark: SparkSession, endpoint: str, raw: str, fetch: Fetch = read_url, bulk_url: str = "", key: str = "", status: str = "ALL", page_size: int = 100, max_pages: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(programs, authorities, functions): the bulk table, unless pages are limited; if it has no programs, the paged list.

    """
    if bulk_url and max_pages is None and (paths := stored(spark, [(bulk_url, "listings.csv")], fetch, f"{raw}/sam_assistance", utf8)):
        found = G.listings_from_table(G.read_table(spark, paths["listings.csv"]), bulk_url)
        if not found[0].isEmpty():
            return found
    if not key:
        raise DownloadError("the bulk table of listings gave no programs, and the paged list needs a key")
    address = f"{endpoint}?{urlencode({'api_key': key, 'status': status, 'pageSize': page_size})}".replace("{", "{{").replace("}", "}}") + "&pageNumber={}"
    try:
        listed = paged_list(spark, Paging(address, first=1, by_item=False, size=page_size, totals=("totalPages",), pages=max_pages), f"{raw}/sam_assistance/pages", fetch)
    except Exception as e:  # whatever a page failed by
        raise DownloadError(f"a page of listings failed: {str(e)[-500:]}") from e
    shown = F.regexp_replace("url", r"api_key=[^&]*&", "")
    return G.listings_from_json(listed.orderBy("at").select("payload", shown.alias("source_url")))


def tax_expenditures(spark: SparkSession, workbook_url: str, year: int, raw: str, fetch: Fetch = read_url) -> DataFrame:
    """Provisions of the year's workbook."""
    got = answers(asked(spark, [workbook_url]), fetch, f"{raw}/treasury_tax_expenditures")
    if bad := failures(got).first():
        raise DownloadError(f"{workbook_url}: {bad['reason']}")
    return G.tax_expenditures(got.select(F.col("body").alias("content"), F.lit(str(year)).alias("fiscal_year"), F.col("url").alias("source_url")))


MOST_LINKS = 100


def archive(spark: SparkSession, main_url: str, raw: str, fetch: Fetch = read_url, reference_csv_url: str = "", host: str = "performance.gov") -> DataFrame:
    """Historical programs: of the reference table, else of the tables on the main page and on pages of the archive's host
    that it links, one hop away, whose label or address tells of programs; the first MOST_LINKS links at most."""
    raw = f"{raw}/performance_fpi_archive"
    if reference_csv_url and (paths := stored(spark, [(reference_csv_url, "reference.csv")], fetch, raw, utf8)):
        found = G.archive_from_table(G.read_table(spark, paths["reference.csv"]), reference_csv_url)
        if not found.isEmpty():
            return found
    main = answers(asked(spark, [main_url]), fetch, f"{raw}/main")
    if bad := failures(main).first():
        raise DownloadError(f"{main_url}: {bad['reason']}")
    out = links(main.select("final", "body"), "body", numbered=True).withColumn("url", F.regexp_replace(U.joined("final", "href"), r"\s+$", ""))
    out = out.filter(F.lower(F.concat_ws(" ", "label", "url")).contains("program") & F.col("url").startswith("http") & F.col("url").contains(host))
    out = out.orderBy("at").limit(MOST_LINKS).filter(F.col("url") != F.col("final"))
    out = out.groupBy("url").agg(F.min("at").alias("at"), F.min_by("label", "at").alias("label"))
    out = web.written(out.select("at", "url", F.col("at").alias("site"), F.lit(None).cast("string").alias("policy"), F.lit(None).cast("long").alias("budget"), "label"), f"{raw}/links")
    hops = answers(out, fetch, f"{raw}/pages")
    page = lambda got, at, label: got.filter("outcome = 'read'").select(at.alias("at"), _text("body").alias("html"), F.col("final").alias("url"), label.alias("agency"))
    return G.archive_from_pages(page(main, F.lit(-1), F.lit("")).union(page(hops, F.col("at"), F.col("label"))).orderBy("at"), agency="agency")


# statutes


def title_links(page: str | None) -> list[tuple[str, str, str]]:
    """(href, label, text of the innermost row, entry or paragraph around it) of the links of a page, in page order."""
    out = []

    def walk(node: D.Node, around: str) -> None:
        stack = [(node, around)]
        while stack:
            node, around = stack.pop()
            if node.tag in ("tr", "li", "p", "div"):
                around = " ".join(node.strings())
            if node.tag == "a" and node.attrs.get("href"):
                out.append((node.attrs["href"], " ".join(node.strings()), around))
            stack += [(x, around) for x in reversed(node.items) if isinstance(x, D.Node)]

    walk(D.page_tree(page), "")
    return out


def title_link(found: list[tuple[str, str, str]], title: str) -> str:
    """The first XML link that stands beside the title's name, else the first whose address has the title's number; or none."""
    named, numbered = re.compile(rf"\btitle\s+0*{re.escape(title)}\b", re.I), re.compile(rf"usc0*{re.escape(title)}(?:\D|$)")
    xml = [(href, around) for href, label, around in found if label.lower() == "xml" or "xml" in href.lower()]
    return next((h for h, around in xml if named.search(around)), "") or next((h for h, _ in xml if "xml" in h.lower() and numbered.search(h.lower())), "")


def unzipped(body: bytes) -> bytes:
    """The first XML file of an archive; any other body as it is."""
    if not body.startswith(b"PK"):
        return body
    with zipfile.ZipFile(io.BytesIO(body)) as z:
        return z.read(next(n for n in z.namelist() if n.lower().endswith(".xml")))


def statute_titles(spark: SparkSession, authorities: DataFrame, download_page: str, raw: str, fetch: Fetch = read_url) -> DataFrame:
    """(usc_title, xml) of the titles that authorities cite, for `enrich_authorities`. What the folder has is not read again;
    a title that cannot be found is left out."""
    folder = f"{raw}/uscode/xml"
    cited = authorities.filter(N.strip("usc_title").rlike(r"^\d+$") & (N.strip("usc_section") != "")).select(N.strip("usc_title").alias("t"))
    titles = sorted({int(r["t"]) for r in cited.distinct().collect()})  # some 50 titles
    name = lambda t: f"usc{t:02d}.xml"
    paths = {name(t): path for t in titles if web.exists(spark, path := f"{folder}/{name(t)}")}
    if missing := [t for t in titles if name(t) not in paths]:
        page = answers(asked(spark, [download_page]), fetch, f"{raw}/uscode/page")
        first = page.filter("outcome = 'read'").select("final", _text("body").alias("html")).first()
        found = title_links(first["html"]) if first else []
        files = [(urljoin(first["final"], link), name(t)) for t in missing if (link := title_link(found, str(t)))]
        paths |= stored(spark, files, fetch, folder, unzipped) if files else {}
    out = spark.createDataFrame([(str(t), paths[name(t)]) for t in titles if name(t) in paths], "usc_title string, __path string")
    if not paths:
        return out.select("usc_title", F.lit("").alias("xml"))
    files = spark.read.format("binaryFile").load(sorted(set(paths.values()))).select(F.element_at(F.split("path", "/"), -1).alias("__name"), F.col("content").alias("xml"))
    return out.withColumn("__name", F.element_at(F.split("__path", "/"), -1)).join(files, "__name").select("usc_title", "xml")
