"""Commit logs and lineage as edge frames."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tablewright.operators.skew import join_per_key
from tablewright.session import persist_to_shared, scratch

FEW = 1 << 16  # nodes whose pointers are simply doubled


def log_by_prefix(commits: DataFrame, prefixes: list[str], n: int) -> DataFrame:
    """The newest ``n`` commits that touch one of the prefixes."""
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | F.col("prefix").startswith(p)
    return commits.where(hit).orderBy(F.desc("ts"), F.desc("commit_id")).limit(n)


def latest_commit(commits: DataFrame, by: str = "prefix") -> DataFrame:
    """Newest commit per prefix: a running maximum, so a busy prefix needs no sort."""
    newest = F.max(F.struct("ts", "commit_id", "committer")).alias("c")
    return commits.groupBy(by).agg(newest).select(by, "c.commit_id", "c.committer", "c.ts")


def commit_ids(commits: DataFrame) -> DataFrame:
    """Content-derived ids: equal parent, prefix, committer and time give the same id on any machine."""
    content = F.concat_ws("|", F.coalesce("parent_id", F.lit("")), "prefix", "committer", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return commits.withColumn("content_id", F.sha2(content, 256))


def branch_heads(commits: DataFrame, branch: str) -> DataFrame:
    """The ref list implied by a log: each branch with its newest commit and how many it has."""
    newest = F.max(F.struct("ts", "commit_id")).alias("c")
    return commits.groupBy(branch).agg(newest, F.count(F.lit(1)).alias("n_commits")).select(
        F.col(branch).alias("ref"), F.col("c.commit_id").alias("commit_id"), "n_commits"
    )


def lineage_edges(commits: DataFrame, key_prefix: str = "source.") -> DataFrame:
    """Edges (commit_id, kind, source) from metadata keys such as ``source.url`` or ``source.commit``."""
    return (
        commits.select("commit_id", F.explode("metadata").alias("key", "source"))
        .where(F.col("key").startswith(key_prefix))
        .select("commit_id", F.substr("key", F.lit(len(key_prefix) + 1)).alias("kind"), "source")
    )


def origins(parents: DataFrame, max_rounds: int = 40, few: int = FEW) -> DataFrame:
    """For a forest (node, parent; roots have a null parent): node, its root and the number of steps.

    While more than ``few`` nodes have a parent, about a quarter of them is taken out and their children point past
    them: those whose hash of this level says so and whose parent's does not, so no taken node points at another. What
    is left is solved by doubling pointers, then the taken nodes are put back level by level. As every level has three
    quarters of the rows of the one before, all joins together move a few times the nodes, however long the chains are.
    Where nodes repeat, all is done by doubling. Every level's result is written to the shared folder.
    """
    # A root points at itself with 0 steps; "done" once the pointer rests on a root.
    jump = parents.select(
        "node", F.coalesce("parent", "node").alias("to"),
        F.when(F.col("parent").isNull(), 0).otherwise(1).cast("bigint").alias("steps"),
        F.col("parent").isNull().alias("done"),
    )
    jump = persist_to_shared(jump, "origins")
    left = jump.where(~F.col("done")).count()
    if left <= few or not jump.where("node is not null").groupBy("node").count().where("count > 1").isEmpty():
        return _doubled(jump, max_rounds)
    rest, taken, before = jump.where(~F.col("done")).drop("done"), [], 2 * left
    while left > few and left * 10 < before * 9:  # a level that takes out next to nothing has cycles: doubling finds them
        coin = [F.pmod(F.xxhash64(F.lit(len(taken)), c), F.lit(2)) for c in ("node", "to")]
        out = (coin[0] == 1) & (coin[1] == 0)
        taken.append(persist_to_shared(rest.where(out), "taken"))
        via = taken[-1].select(F.col("node").alias("to"), F.col("to").alias("next"), F.col("steps").alias("more"))
        rest = rest.where(~out).join(via, "to", "left").select(
            "node", F.coalesce("next", "to").alias("to"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")
        )
        rest = persist_to_shared(rest, "rest")
        before, left = left, rest.count()
    # Roots are not in the rest: a pointer to a node that is not listed ends there.
    found = _doubled(rest.withColumn("done", F.lit(False)), max_rounds)
    for level in reversed(taken):
        known = found.select(F.col("node").alias("to"), "origin", F.col("steps").alias("more"))
        back = level.join(known, "to", "left").select(
            "node", F.coalesce("origin", "to").alias("origin"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")
        )
        found = found.unionByName(persist_to_shared(back, "back"))
    return found.unionByName(jump.where("done").select("node", F.col("to").alias("origin"), "steps"))


def _doubled(jump: DataFrame, max_rounds: int) -> DataFrame:
    """Every round doubles the distance each pointer spans, so a chain of n nodes needs log2(n) joins. A round's result
    is written to the shared folder: lineage stays short, and a lost executor recomputes one round only."""
    for _ in range(max_rounds):
        if jump.where(~F.col("done")).isEmpty():
            return jump.select("node", F.col("to").alias("origin"), "steps")
        settled, pending = jump.where("done"), jump.where(~F.col("done"))
        via = jump.select(F.col("node").alias("to"), F.col("to").alias("next"), F.col("steps").alias("more"), F.col("done").alias("at_root"))
        # After a few rounds many nodes rest on the same few ancestors: those are looked up without a shuffle.
        wanted = pending.groupBy("to").agg(F.count(F.lit(1)).alias("n"))
        moved = join_per_key(pending, via.join(wanted, "to"), ["to"], "n", "node", "left").select(
            "node", F.coalesce("next", "to").alias("to"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.coalesce("at_root", F.lit(True)).alias("done"),  # a parent that is not listed ends the trail
        )
        jump = persist_to_shared(settled.unionByName(moved), "origins")
    raise ValueError("parent chain is longer than 2^max_rounds, or has a cycle")


def upstream(edges: DataFrame, targets: DataFrame) -> DataFrame:
    """All ancestors of the targets in a graph (source, target): rows (node, hops), nearest distance.

    One join per level; each level is written to the shared folder, and nodes met before are not
    visited again, so cycles end, nothing is written twice, and any depth is followed. Where every node has one
    parent, ``origins`` needs far fewer joins.
    """
    spark = edges.sparkSession
    folder = scratch(spark, "upstream")

    def put(level: DataFrame, hop: int) -> DataFrame:
        level.write.parquet(f"{folder}/hops={hop}")
        return spark.read.schema(level.schema).parquet(f"{folder}/hops={hop}")

    frontier = put(targets.select("node").distinct(), 0)
    for hop in itertools.count(1):
        seen = spark.read.schema(targets.select("node").schema.add("hops", LongType())).parquet(folder)
        step = edges.join(frontier.select(F.col("node").alias("target")), "target", "left_semi")
        fresh = step.select(F.col("source").alias("node")).distinct().join(seen.select("node"), "node", "left_anti")
        frontier = put(fresh, hop)
        if frontier.isEmpty():
            return seen
