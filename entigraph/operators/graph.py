"""Graph operators: connected components, and unions that respect which records must stay apart."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, spark.checkpoint.dir. Where it is unset, a temporary one will
    do if everything runs in one process; a cluster has to name one."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    known = sc._jsc.sc().getCheckpointDir()
    if not folder and known.isDefined():
        folder = known.get().rsplit("/", 1)[0]
    if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    folder = folder or "file://" + tempfile.mkdtemp(prefix="shared-")
    if known.isEmpty():
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


@lru_cache(maxsize=8)
def _own_folder(shared: str) -> str:
    return f"{shared}/tables-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the store may be gone, or the session
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def reliable(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a table in the shared folder, which goes with the driver's process.

    A checkpoint would do, but hands on its plan's estimates: over a few rounds of self-joins these become numbers of
    millions of digits. A table has its real size, by which Spark finds what it can broadcast.
    """
    spark = df.sparkSession
    root = _own_folder(shared_folder(spark))
    if root not in _REMOVED_LATER:
        _REMOVED_LATER.add(root)
        atexit.register(_remove, spark, root)
    df = df.withColumns({c: F.lit(None).cast("string") for c, kind in df.dtypes if kind == "void"})
    df.write.parquet(path := f"{root}/{uuid.uuid4().hex}")
    return spark.read.schema(df.schema).parquet(path)


_REMOVED_LATER: set[str] = set()


def connected_components(nodes: DataFrame, edges: DataFrame, most: int = 60) -> DataFrame:
    """(id, root) for all nodes (id); edges are (a, b) in any order; root is the smallest id reachable.

    Each round every node takes the least root among its neighbours and itself, and roots follow their own roots, so
    chains shrink by half a round.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = reliable(both)
    now = reliable(nodes.select("id", F.col("id").alias("root")))
    for _ in range(most):
        near = both.join(now.select(F.col("id").alias("b"), F.col("root").alias("r")), "b").groupBy("a").agg(F.min("r").alias("r"))
        new = now.join(near.withColumnRenamed("a", "id"), "id", "left").select("id", F.col("root").alias("was"), F.least("root", F.coalesce("r", "root")).alias("root"))
        # the old root takes the new one, and everything follows its root's root
        hook = new.groupBy(F.col("was").alias("id")).agg(F.min("root").alias("h"))
        new = new.join(hook.withColumnRenamed("id", "w"), F.col("was") == F.col("w")).select("id", "was", F.least("root", "h").alias("root"))
        up = new.select(F.col("id").alias("p"), F.col("root").alias("up"))
        new = reliable(new.join(up, F.col("root") == F.col("p")).select("id", "was", F.least("root", "up").alias("root")))
        now = new.select("id", "root")
        if not new.filter("root <> was").limit(1).count():
            return now
    raise RuntimeError("components did not settle")


#: Rounds that double what a group knows of its chain of picks, before the chains' ends are looked at.
DOUBLINGS = 3
ORDER = "struct<key:string,left:bigint,right:bigint>"


def _followed(picks: DataFrame) -> DataFrame:
    """(g, to, o): the end of each group's chain of picks (g, to, o). Two groups that pick each other end in the lesser."""
    back = picks.select(F.col("g").alias("b"), F.col("to").alias("again"))
    own = picks.join(back, F.col("to") == F.col("b"), "left")
    now = own.select("g", F.when((F.col("again") == F.col("g")) & (F.col("g") < F.col("to")), F.col("g")).otherwise(F.col("to")).alias("to"), "o")
    while True:
        for _ in range(DOUBLINGS):
            on = now.select(F.col("g").alias("b"), F.col("to").alias("further"))
            now = now.join(on, F.col("to") == F.col("b"), "left").select("g", F.coalesce("further", "to").alias("to"), "o")
        now = reliable(now)
        on = now.select(F.col("g").alias("b"), F.col("to").alias("further"))
        if now.join(on, F.col("to") == F.col("b")).filter("further <> to").isEmpty():
            return now


def priority_forest(codes: DataFrame, edges: DataFrame) -> tuple[DataFrame, list[DataFrame], DataFrame, DataFrame]:
    """What uniting the ends of edges in ascending order gives if groups of two codes must never meet.

    codes: (id, code), the code null where there is none; edges: (o, left, right), o the order, each pair once. Returns
    (id, g): each node's last group; the rounds (g, to, o), by which groups were joined; the edges that joined two groups;
    and those that would have joined two codes.

    In each round every group without a code takes its least edge, wherever that leads: when that edge's turn comes
    nothing else of the group has had one, so it is still by itself and cannot be refused. A group with a code does so if
    its least edge leads to its own code. An edge between two codes is refused at once: a group's code is there before
    any of its edges that are left has its turn. So groups without a code halve each round, and the rest after them.
    """
    nodes = reliable(edges.select(F.col("left").alias("id")).union(edges.select("right")).distinct().join(codes, "id"))
    groups, rounds, refused = nodes.select(F.col("id").alias("g"), "code"), [], []
    live = edges.select("o", F.col("left").alias("u"), F.col("right").alias("v"))
    while True:
        side = lambda c: groups.select(F.col("g").alias(c), F.col("code").alias(f"{c}_code"))
        live = reliable(live.filter("u <> v").join(side("u"), "u").join(side("v"), "v"))
        clash = F.coalesce(F.col("u_code") != F.col("v_code"), F.lit(False))
        refused.append(live.filter(clash).select("o"))
        live = live.filter(~clash).select("o", "u", "v", "u_code", "v_code")
        both = live.union(live.select("o", "v", "u", "v_code", "u_code"))
        least = both.groupBy(F.col("u").alias("g")).agg(F.min_by(F.struct("o", "v", "u_code", "v_code"), "o").alias("e"))
        picks = reliable(least.filter("e.u_code is null or e.u_code = e.v_code").select("g", F.col("e.v").alias("to"), F.col("e.o").alias("o")))
        if picks.isEmpty():
            break
        step = _followed(picks)
        rounds.append(step)
        ends = step.select(F.col("g").alias("was"), "to")
        moved = lambda df, c: df.join(ends, F.col(c) == F.col("was"), "left").withColumn(c, F.coalesce("to", c)).drop("was", "to")
        groups = reliable(moved(groups, "g").groupBy("g").agg(F.max("code").alias("code")))
        live = moved(moved(live.select("o", "u", "v"), "u"), "v")
    last = nodes.select("id", F.col("id").alias("g"))
    joined = None
    for step in rounds:
        ends = step.select(F.col("g").alias("was"), "to")
        last = last.join(ends, F.col("g") == F.col("was"), "left").select("id", F.coalesce("to", "g").alias("g"))
        joined = step.select("o") if joined is None else joined.union(step.select("o"))
    every = refused[0]
    for more in refused[1:]:
        every = every.union(more)
    return reliable(last), rounds, joined.distinct() if joined is not None else every.limit(0), every


def _met(rounds: list[DataFrame], sources: DataFrame, asked: DataFrame) -> DataFrame:
    """The rows of asked (q, o, id, what) whose node has met a source (id, what) by edges before o.

    Of two nodes in one group, the greatest edge between them is the greatest that either's groups took on their way to
    the group where they meet. So it is enough to hold each node's way up, and for each group and `what` the least of
    the sources' ways.
    """
    none = F.struct(F.lit(False).alias("any"), F.lit(None).cast(ORDER).alias("o"))
    up = lambda df: df.withColumn("g", F.col("id")).withColumn("most", none)
    here, there, met = up(asked), up(sources), None
    for step in [None, *rounds]:
        if step is not None:
            taken = step.select(F.col("g").alias("was"), "to", F.struct(F.lit(True).alias("any"), F.col("o")).alias("e"))
            climb = lambda df: df.join(taken, F.col("g") == F.col("was"), "left").withColumns({"g": F.coalesce("to", "g"), "most": F.greatest("most", F.coalesce("e", "most"))}).drop("was", "to", "e")
            here, there = reliable(climb(here)), reliable(climb(there))
        least = there.groupBy("g", "what").agg(F.min("most").alias("least"))
        before = lambda c: (~F.col(f"{c}.any")) | (F.col(f"{c}.o") < F.col("o"))
        hit = here.join(least, ["g", "what"]).filter(before("most") & before("least")).select("q", "what")
        met = hit if met is None else met.union(hit)
    return met.distinct()


def constrained_union(records: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Greedy unions in the order (key, left, right) that never join two different codes.

    records: id, code (empty: none), parent. pairs: key, left, right; of a pair's keys only the least counts. Returns
    (id, root), root the least id of its group, and the decisions (left, right, key, decision): auto_merge for each pair
    that joins two groups, manual_review or deterministic_separate for each that must not (the former if, at its turn,
    records of the two codes name the same parent). See priority_forest: a few joins each round, of which there are some
    log2 of the largest component; records without a pair take no part.
    """
    first = pairs.groupBy("left", "right").agg(F.min("key").alias("key"))
    edges = reliable(first.select(F.struct("key", "left", "right").alias("o"), "left", "right"))
    info = records.select("id", F.when(F.col("code") != "", F.col("code")).alias("code"), "parent")
    last, rounds, joined, refused = priority_forest(info.select("id", "code"), edges)
    root = last.groupBy("g").agg(F.min("id").alias("root"))
    named = last.join(root, "g").select("id", "root")
    roots = records.select("id").join(named, "id", "left").select("id", F.coalesce("root", "id").alias("root"))
    refused = reliable(refused)
    decided = joined.select("o.left", "o.right", F.concat(F.lit("deterministic_alias_key:"), F.col("o.key")).alias("key"), F.lit("auto_merge").alias("decision"))
    if refused.isEmpty():
        return reliable(roots), reliable(decided)

    coded = last.join(info.filter("code is not null"), "id").select("g", "id", F.col("parent").alias("what"))
    own = coded.filter("what <> ''").select("g", "what").distinct()
    at = lambda c: last.select(F.col("id").alias(c), F.col("g").alias(f"g_{c}"))
    placed = refused.select("o", F.col("o.left").alias("left"), F.col("o.right").alias("right")).join(at("left"), "left").join(at("right"), "right")
    shared = placed.join(own.select(F.col("g").alias("g_left"), "what"), "g_left").join(own.select(F.col("g").alias("g_right"), "what"), ["g_right", "what"])
    # a group whose coded records name one parent names it from the start; elsewhere it matters who had come by then
    mixed = coded.groupBy("g").agg((F.min("what") != F.max("what")).alias("mixed"))
    of = lambda c: mixed.select(F.col("g").alias(f"g_{c}"), F.col("mixed").alias(f"m_{c}"))
    shared = reliable(shared.join(of("left"), "g_left").join(of("right"), "g_right"))
    sure = shared.filter("not m_left and not m_right").select("o")
    doubt = shared.filter("m_left or m_right")
    if not doubt.isEmpty():
        side = lambda c: doubt.select(F.struct("o", F.lit(c).alias("side")).alias("q"), "o", F.col(c).alias("id"), "what")
        asked = side("left").union(side("right"))
        groups = doubt.select(F.col("g_left").alias("g")).union(doubt.select("g_right")).distinct()
        met = _met(rounds, coded.join(groups, "g").filter("what <> ''").select("id", "what"), asked)
        sure = sure.union(met.groupBy(F.col("q.o").alias("o"), "what").count().filter("count = 2").select("o"))
    same = sure.select("o.left", "o.right").distinct().withColumn("same", F.lit(True))
    apart = refused.select("o.left", "o.right").join(same, ["left", "right"], "left")
    apart = apart.select("left", "right", F.lit("distinct_opm_subagency_codes").alias("key"), F.when(F.col("same"), "manual_review").otherwise("deterministic_separate").alias("decision"))
    return reliable(roots), reliable(decided.union(apart))
