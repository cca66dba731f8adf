"""Reading of addresses: one function for one address, policies of hosts, a table of what was read, a store of bodies.

Whoever needs addresses gives a table of requests; `fetched` reads them on the executors. What the answers mean is told by
plain columns afterwards.
"""

from __future__ import annotations

import contextlib
import time
import uuid
from collections.abc import Callable
from typing import NamedTuple
from urllib.error import HTTPError
from urllib.parse import urlsplit, urlunsplit
from urllib.request import Request, build_opener
from urllib.robotparser import RobotFileParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

AGENT = "entigraph/1.0 (public-interest research)"
PAGE_BYTES, DOCUMENT_BYTES, TABLE_BYTES = 4_000_000, 25_000_000, 1_000_000_000
BLOCK = 1 << 16


class Answer(NamedTuple):
    body: bytes
    kind: str
    url: str


Fetch = Callable[..., tuple[bytes, str, str]]
Save = Callable[[str, bytes], str]


def read_url(url: str, max_bytes: int = PAGE_BYTES, seconds: int = 25) -> Answer:
    """Body, content type and final address; reading stops with an error where the body is longer than `max_bytes`."""
    taken = bytearray()
    with build_opener().open(Request(url, headers={"User-Agent": AGENT}), timeout=seconds) as source:
        while block := source.read(BLOCK):
            taken += block
            if len(taken) > max_bytes:
                raise ValueError(f"{url} has more than {max_bytes} bytes")
        return Answer(bytes(taken), source.headers.get("Content-Type") or "", source.url)


class Policies:
    """What the robots files of hosts let this program read. A host is asked once, when it is first met."""

    FORBIDDING = (401, 403)  # a file that may not be read forbids all; one that is missing or broken, nothing

    def __init__(self, fetch: Fetch):
        self.fetch, self.known = fetch, {}

    def _rules(self, scheme: str, host: str) -> RobotFileParser:
        rules = RobotFileParser()
        try:
            text = Answer(*self.fetch(urlunsplit((scheme, host, "/robots.txt", "", "")))).body.decode("utf-8", "replace")
        except HTTPError as e:
            rules.disallow_all, rules.allow_all = e.code in self.FORBIDDING, e.code not in self.FORBIDDING
        except Exception:  # noqa: BLE001  whatever is wrong with a host
            rules.allow_all = True
        else:
            rules.parse(text.splitlines())
        return rules

    def allows(self, url: str, of: str | None = None) -> bool:
        """Whether `url` may be read under the policy of its own host, or of the host of `of`."""
        place = urlsplit(of or url)[:2]
        if place not in self.known:
            self.known[place] = self._rules(*place)
        return self.known[place].can_fetch(AGENT, url)


ANSWER = "outcome string, error string, final string, kind string, body binary"


def fetched(requests: DataFrame, fetch: Fetch = read_url, max_bytes: int = PAGE_BYTES, wait: float = 0.0) -> DataFrame:
    """`requests` with outcome, error, final, kind and body of each address. Write it before use: each reading fetches again.

    Columns used: url; site (rows of one site have to stand together, in the order in which they are to be read); policy (the
    address whose robots file decides, null: none does); budget (addresses of the site that may still be read, null: all).
    outcome is read, failed, robots (the policy forbids it; costs no budget) or left (the budget was used up).
    """
    names = requests.columns
    at = {c: names.index(c) for c in ("url", "site", "policy", "budget")}

    def run(batches):
        site, done, policies = None, 0, Policies(fetch)
        for batch in batches:
            told = []
            for url, own, policy, budget in zip(*(batch.column(at[c]).to_pylist() for c in ("url", "site", "policy", "budget")), strict=True):
                if own != site:
                    site, done, policies = own, 0, Policies(fetch)
                if budget is not None and done >= budget:
                    told.append(("left", None, None, None, None))
                elif policy is not None and not policies.allows(url, policy):
                    told.append(("robots", None, None, None, None))
                else:
                    done += 1
                    try:
                        answer = Answer(*fetch(url, max_bytes=max_bytes))
                        told.append(("read", None, answer.url, answer.kind, answer.body))
                    except Exception as e:  # noqa: BLE001  one address must not end the run
                        told.append(("failed", f"{type(e).__name__}:{e}", None, None, None))
                    time.sleep(wait)
            kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([r[i] for r in told], kind) for i, kind in enumerate(kinds))], [*names, "outcome", "error", "final", "kind", "body"])

    return requests.mapInArrow(run, T.StructType([*requests.schema.fields, *T.StructType.fromDDL(ANSWER).fields]))


def replayed(requests: DataFrame, archive: DataFrame) -> DataFrame:
    """What `fetched` would give if the web were `archive`: (url, final, kind, body), one row for each address it has.

    An address without a row fails; a site whose robots file is not in the archive allows everything, one that has it in
    there with a line "Disallow: /" nothing. The join reads the archive once, however large it is.
    """
    names = requests.columns
    at = Window.partitionBy("site").orderBy("place")
    robots = archive.filter("url like '%/robots.txt' and cast(body as string) rlike '(?im)^Disallow: */ *$'").select(F.regexp_replace("url", "/robots[.]txt$", "").alias("__closed"))
    home = F.regexp_extract(F.coalesce("policy", F.lit("")), "^[^:]*://[^/?#]*", 0)
    rows = requests.join(robots, home == F.col("__closed"), "left").withColumn("__open", F.col("__closed").isNull())
    rows = rows.withColumn("__done", F.sum(F.col("__open").cast("int")).over(at)).withColumn("__left", F.coalesce(F.col("__done") > F.col("budget"), F.lit(False)))
    known = archive.select(F.col("url").alias("__url"), F.col("final").alias("__final"), F.col("kind").alias("__kind"), F.col("body").alias("__body"))
    rows = rows.join(known, F.col("__open") & ~F.col("__left") & (F.col("url") == F.col("__url")), "left")
    outcome = F.when(~F.col("__open"), "robots").when(F.col("__left"), "left").when(F.col("__url").isNull(), "failed").otherwise("read")
    error = F.when(outcome == "failed", F.concat(F.lit("KeyError:"), "url"))
    return rows.select(*names, outcome.alias("outcome"), error.alias("error"), F.col("__final").alias("final"), F.col("__kind").alias("kind"), F.col("__body").alias("body"))


def written(df: DataFrame, folder: str) -> DataFrame:
    """`df` as a Parquet table in the folder, read from there: what was fetched once is not fetched again."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


class Folder:
    """A store of bodies under given names, in any file system that Arrow knows; executors have to see it, too."""

    def __init__(self, place: str):
        self.place = place.rstrip("/")

    def __call__(self, name: str, body: bytes) -> str:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.place) if "://" in self.place else (fs.LocalFileSystem(), self.place)
        system.create_dir(path, recursive=True)
        part = f"{path}/.{uuid.uuid4().hex}"
        try:
            with system.open_output_stream(part) as out:
                out.write(body)
            system.move(part, f"{path}/{name}")  # whole or not at all, whichever task writes it
        except BaseException:
            with contextlib.suppress(Exception):
                system.delete_file(part)
            raise
        return f"{self.place}/{name}"


def snapshots(df: DataFrame, save: Save, ending: str = "ending", body: str = "body") -> DataFrame:
    """`df` without body and ending, with sha256 and snapshot_path of the bodies that have an ending; names are digests."""
    digest = F.when(F.col(ending).isNotNull(), F.sha2(F.col(body).cast("binary"), 256)).otherwise("")
    df = df.withColumn("sha256", digest)
    keep = [c for c in df.columns if c not in (body, ending)]

    def run(batches):
        for batch in batches:
            rows = zip(batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist(), batch.column(keep.index("sha256")).to_pylist(), strict=True)
            paths = [save(f"{digest}.{end}", raw) if end else "" for raw, end, digest in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(paths, pa.string())], [*keep, "snapshot_path"])

    schema = T.StructType([*df.select(*keep).schema.fields, T.StructField("snapshot_path", T.StringType())])
    return df.select(*keep, F.col(body), F.col(ending)).mapInArrow(run, schema)
