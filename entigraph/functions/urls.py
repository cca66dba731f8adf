"""Addresses of pages and what their labels and paths tell."""

from __future__ import annotations

from urllib.parse import urldefrag, urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import _col, strip, text


def domain(c: Column | str) -> Column:
    """Host in lower case without a leading "www."; https is assumed where no scheme is given."""
    value = text(c)
    url = F.when(value.contains("://"), value).otherwise(F.concat(F.lit("https://"), value))
    host = F.lower(F.regexp_extract(url, r"^[^:]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1))
    return F.when(value == "", F.lit("")).otherwise(F.regexp_replace(F.regexp_replace(host, r"[\[\]]", ""), r"^www\.", ""))


def normalized_url(c: Column | str) -> Column:
    return strip(F.split(text(c), "#", 2)[0])


def same_site(url: Column | str, seed: Column | str) -> Column:
    host, root = domain(url), domain(seed)
    return (root != "") & ((host == root) | host.endswith(F.concat(F.lit("."), root)))


def official_document(url: Column | str, seed: Column | str) -> Column:
    host = domain(url)
    return same_site(url, seed) | host.endswith(".gov") | host.endswith(".mil")


@F.pandas_udf(T.StringType())
def resolved(base: pd.Series, href: pd.Series) -> pd.Series:
    """The absolute address of a link on a page, without its fragment."""
    out = []
    for b, h in zip(base, href, strict=True):
        try:
            out.append(urldefrag(urljoin(b or "", h or ""))[0].strip())
        except ValueError:
            out.append("")
    return pd.Series(out)


@F.pandas_udf(T.StringType())
def joined(base: pd.Series, href: pd.Series) -> pd.Series:
    """The absolute address of a link on a page; empty where there is none."""

    def one(b: str | None, h: str | None) -> str:
        try:
            return urljoin(b or "", h or "")
        except ValueError:
            return ""

    return pd.Series(map(one, base, href), dtype=object)


def year_candidates(c: Column | str) -> Column:
    """Sorted years 19xx and 20xx that stand alone, and fiscal years FYxx as 20xx."""
    full = F.regexp_extract_all(text(c), F.lit(r"(?<!\d)((?:19|20)\d{2})(?!\d)"), 1)
    short = F.transform(F.regexp_extract_all(text(c), F.lit(r"(?i)\bFY[ _-]?(\d{2})(?!\d)"), 1), lambda y: F.concat(F.lit("20"), y))
    return F.array_sort(F.array_distinct(F.concat(full, short)))


def unquoted_path(c: Column | str) -> Column:
    path = F.regexp_extract(_col(c), r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    return F.regexp_replace(F.coalesce(F.try_url_decode(path), path), "[-_+/]", " ")
