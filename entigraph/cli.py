"""Command line: doctor, sources, organizations, programs, reports.

Sources are downloaded unless saved inputs are given or they are skipped. Results go to data/processed of the project's
folder and raw answers to data/raw, or where --out and --raw say; both may be any store that Spark and Arrow know.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys

from . import __version__, config

LOG = logging.getLogger(__name__)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="entigraph", description="Compiles source records into a registry of organizations and programs.")
    p.add_argument("--version", action="version", version=__version__)
    p.add_argument("--verbose", action="store_true")
    p.add_argument("--out", help="folder of the results")
    p.add_argument("--raw", help="folder of raw answers")
    p.add_argument("--config", help="settings that override the defaults")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("doctor", help="checks the environment")
    sub.add_parser("sources", help="lists the known sources")
    o = sub.add_parser("organizations", help="builds the organization registry")
    o.add_argument("--source-csv", action="append", default=[], help="saved source records instead of downloads (repeatable)")
    o.add_argument("--fpi-csv", help="inventory with Department and Agency columns")
    o.add_argument("--statutory-csv", help="curated rows, added where they are missing")
    o.add_argument("--overrides-csv", help="reviewed identity decisions")
    for name in ("usagov", "federal-register", "govinfo", "opm"):
        o.add_argument(f"--{name}", help=f"saved raw input of {name} instead of a download")
        o.add_argument(f"--skip-{name}", action="store_true")
    g = sub.add_parser("programs", help="builds the program registry")
    g.add_argument("--source-csv", help="saved program records instead of downloads")
    g.add_argument("--sam-csv", help="saved bulk table of listings")
    g.add_argument("--treasury-xlsx", help="saved workbook of tax expenditures")
    g.add_argument("--performance-csv", help="saved reference table of the archive")
    g.add_argument("--supplemental-csv", action="append", default=[])
    for name in ("sam", "treasury", "performance", "uscode"):
        g.add_argument(f"--skip-{name}", action="store_true")
    g.add_argument("--max-sam-pages", type=int, help="pages of listings to read at most; the bulk table is left aside")
    r = sub.add_parser("reports", help="looks for performance reports on the sites of organizations")
    r.add_argument("--source-csv")
    r.add_argument("--max-pages", type=int, default=40)
    r.add_argument("--max-depth", type=int, default=3)
    r.add_argument("--workers", type=int, default=4)
    r.add_argument("--max-agencies", type=int)
    r.add_argument("--download-reports", action="store_true")
    return p


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("entigraph").config("spark.ui.showConsoleProgress", "false").getOrCreate()


def _table(spark, path: str):
    return spark.read.csv(path, header=True, multiLine=True, escape='"').na.fill("")


def _ordered(frames: list):
    """The frames under the union of their columns, with rec_idx: rows in the order of the frames, and within each as its own
    rec_idx or, without one, as read. The numbers have gaps, so that no frame has to be counted."""
    from pyspark.sql import functions as F

    from .operators import ordered

    out = []
    for i, df in enumerate(frames):
        own = F.col("rec_idx").cast("long") if "rec_idx" in df.columns else F.monotonically_increasing_id()
        out.append(df.withColumn("rec_idx", F.lit(i << 56) + own))  # a frame's own numbers stay below 2 ** 56
    return ordered.union_sources(*out)


def organizations(args, fetch=None) -> dict:
    from pyspark.sql import functions as F

    from . import sinks
    from .operators import organizations as O
    from .sources import directories as D
    from .sources import downloads as L
    from .sources import web
    from .sources import workforce as W

    spark, fetch, known = _session(), fetch or web.read_url, args.settings["sources"]
    frames, metrics = [_table(spark, p) for p in args.source_csv], {}
    use = lambda name, skipped: not args.source_csv and not skipped and known[name]["enabled"]
    if use("usagov", args.skip_usagov):
        if args.usagov:
            pages = spark.read.format("binaryFile").load(args.usagov)
            pages = pages.orderBy("path").select(F.monotonically_increasing_id().alias("page_no"), F.col("path").alias("url"), F.decode("content", "UTF-8").alias("html"))
            frames.append(D.agency_index(pages))
        else:
            found, bad = L.agency_index(spark, known["usagov"]["base_url"], known["usagov"]["letters"], args.raw, fetch)
            sinks.write_csv(bad, f"{args.raw}/usagov_failures.csv")
            frames.append(found)
    if use("federal_register", args.skip_federal_register):
        frames.append(D.agency_list(spark.read.text(args.federal_register, wholetext=True).withColumnRenamed("value", "payload")) if args.federal_register else L.agency_list(spark, known["federal_register"]["endpoint"], args.raw, fetch))
    if use("govinfo_govman", args.skip_govinfo):
        if args.govinfo:
            frames.append(D.manual_records(D.manual_details(spark.read.parquet(args.govinfo))))
        else:
            s = known["govinfo_govman"]
            found, audit, bad, how = L.manual(spark, s["package_id"], s["xml_url"], s["publication_date"], args.raw, fetch, s["api_base_url"], config.secret(s), s["api_page_size"], s["workers"])
            folder = f"{args.raw}/govinfo/{s['package_id']}"
            sinks.write_csv(audit, f"{folder}/granules.csv")
            sinks.write_csv(bad, f"{folder}/failures.csv")
            sinks.write_json(spark, how | {"api_key_source": s["api_key_env"] if os.environ.get(s["api_key_env"]) else s["api_key_fallback"]}, f"{folder}/granule_discovery.json")
            frames.append(found)
    if use("opm_fwd", args.skip_opm):
        found = W.workforce_records(spark.read.parquet(args.opm).withColumn("rec_idx", F.monotonically_increasing_id())) if args.opm else L.workforce(spark, known["opm_fwd"]["files_api"], known["opm_fwd"]["download_base_url"], args.raw, fetch)
        frames.append(found.withColumn("rec_idx", F.monotonically_increasing_id()))
    if args.fpi_csv:
        frames.append(D.inventory(_table(spark, args.fpi_csv)))
    if not frames:
        raise SystemExit("no source records were given")
    if args.statutory_csv:
        frames.append(D.missing_statutory(_ordered(frames), _table(spark, args.statutory_csv)))
    records = _ordered(frames)
    for source, n in records.groupBy("source").count().collect():  # a row per source
        metrics[f"{source} records"] = n
    decided = _table(spark, args.overrides_csv).withColumn("o_idx", F.monotonically_increasing_id()) if args.overrides_csv else None
    tables = O.resolve(records, decided, args.settings["resolution"]["review_threshold"])
    summary = sinks.export_organizations(tables, args.out, {"source_records_by_source": metrics})
    sinks.write_csv(sinks.post_table(_table(spark, f"{args.out}/organizations.csv")), f"{args.out}/wordpress_organizations.csv")
    return summary


def programs(args, fetch=None) -> dict:
    from pyspark.sql import functions as F

    from . import sinks
    from .operators import programs as G
    from .sources import downloads as L
    from .sources import programs as S
    from .sources import web

    spark, fetch, known = _session(), fetch or web.read_url, args.settings["sources"]
    authorities = spark.createDataFrame([], "auth_idx long, " + ", ".join(f"{c} {'int' if c == 'authority_sequence' else 'string'}" for c in S.AUTHORITY_COLUMNS))
    functions = spark.createDataFrame([], "source_key string, program_source_record_id string, function_code string, function_name string")
    frames = [_table(spark, args.source_csv)] if args.source_csv else []
    use = lambda name, skipped: not args.source_csv and not skipped and known[name]["enabled"]
    if use("sam_assistance", args.skip_sam):
        s = known["sam_assistance"]
        listed, authorities, functions = S.listings_from_table(S.read_table(spark, args.sam_csv)) if args.sam_csv else L.listings(spark, s["endpoint"], args.raw, fetch, s["bulk_url"], config.secret(s), s["status"], s["page_size"], args.max_sam_pages)
        frames.append(listed)
    if use("treasury_tax_expenditures", args.skip_treasury):
        s = known["treasury_tax_expenditures"]
        books = spark.read.format("binaryFile").load(args.treasury_xlsx).select("content", F.lit(str(s["fiscal_year"])).alias("fiscal_year"), F.col("path").alias("source_url")) if args.treasury_xlsx else None
        frames.append(S.tax_expenditures(books) if args.treasury_xlsx else L.tax_expenditures(spark, s["workbook_url"], s["fiscal_year"], args.raw, fetch))
    if args.performance_csv and not args.source_csv:
        frames.append(S.archive_from_table(S.read_table(spark, args.performance_csv), args.performance_csv))
    elif use("performance_fpi_archive", args.skip_performance):
        s = known["performance_fpi_archive"]
        frames.append(L.archive(spark, s["main_url"], args.raw, fetch, s["reference_csv_url"]))
    frames += [S.supplement_from_table(S.read_table(spark, p), os.path.basename(p)) for p in args.supplemental_csv if not args.source_csv]
    if not frames:
        raise SystemExit("no program records were given")
    registry = {n: _table(spark, f"{args.out}/{n}.csv") for n in ("organizations", "organization_aliases", "organization_sources")}
    if not args.skip_uscode and known["uscode"]["enabled"] and not authorities.filter("trim(usc_title) <> ''").isEmpty():
        authorities = S.enrich_authorities(authorities, L.statute_titles(spark, authorities, known["uscode"]["download_page"], args.raw, fetch))
    else:
        authorities = authorities.withColumn("statutory_purpose_text", F.lit(""))
    tables = G.resolve(_ordered(frames), authorities, functions, registry["organizations"], registry["organization_aliases"], registry["organization_sources"])
    return sinks.export_programs(tables, args.out)


def reports(args, fetch=None) -> dict:
    from . import sinks
    from .sources import reports as R
    from .sources import web

    if args.workers < 1 or (args.max_agencies is not None and args.max_agencies < 1):
        raise SystemExit("--workers and --max-agencies have to be positive")
    spark = _session()
    seeds = R.seeds(_table(spark, args.source_csv or f"{args.out}/organization_sources.csv")).orderBy("rec_idx")
    if not (available := seeds.count()):
        raise SystemExit("the source table names no site of the directory")
    chosen = seeds if args.max_agencies is None else seeds.limit(args.max_agencies)
    raw = f"{args.raw}/agency_reports"
    found = R.crawl(chosen, raw, fetch or web.read_url, web.Folder(f"{raw}/snapshots"), args.max_pages, args.max_depth, args.download_reports, workers=args.workers)
    sinks.write_csv(found.reports, f"{args.out}/agency_report_sources.csv")
    sinks.write_csv(found.coverage, f"{args.out}/agency_report_coverage.csv")
    sinks.write_csv(found.pages, f"{args.out}/agency_report_pages.csv")
    summary = R.summary(found, available, args.max_pages, args.max_depth)
    sinks.write_json(spark, summary, f"{args.out}/agency_report_summary.json")
    return summary


def doctor(args) -> int:
    import shutil

    os.makedirs(args.out, exist_ok=True)
    checks = {"python": sys.version_info >= (3, 11), "java": bool(shutil.which("java") or os.environ.get("JAVA_HOME")), "out_is_writable": os.access(args.out, os.W_OK), "sources": len(args.settings["sources"]) > 0}
    for name, ok in checks.items():
        print(f"{name}: {ok}")
    return 0 if all(checks.values()) else 1


def main(argv: list[str] | None = None, fetch=None) -> int:
    """Runs a command; fetch(url, max_bytes) reads addresses (the web, unless another one is given)."""
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO)
    root = config.project()
    place = str(root or os.getcwd())
    args.out, args.raw = args.out or f"{place}/data/processed", args.raw or (f"{args.out}/raw" if args.out else f"{place}/data/raw")
    file = args.config or (str(root / config.PLACE) if root and (root / config.PLACE).exists() else None)
    args.settings = config.load(file)
    if args.command == "doctor":
        return doctor(args)
    if args.command == "sources":
        print("\n".join(f"{n}: {'enabled' if s.get('enabled') else 'disabled'} ({s.get('kind', 'unknown')})" for n, s in sorted(args.settings["sources"].items())))
        return 0
    run = {"organizations": organizations, "programs": programs, "reports": reports}[args.command]
    print(json.dumps(run(args, fetch), indent=2))
    return 0
