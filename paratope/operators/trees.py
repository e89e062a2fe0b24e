"""Trees of many groups at once by average linkage, from a table of distances.

In a round of a large group each cluster finds the cluster nearest to it, and all pairs that are nearest to each other merge at once. With average
linkage these are merges that the step-by-step method makes too, only together, so a group takes about as many rounds as its tree is
deep, and all groups take them side by side. The distance of two clusters is the mean over the pairs of their members, kept as a
sum and a number, so merging is renaming and adding up. A group that has become small enough is finished by one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paratope.operators.motifs import BASES
from paratope.plans.shared import dropped, written


def average_link(leaves: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merges, roots) of groups of leaves (grp string, leaf string) by the distances of their pairs (grp, i, j, d), each pair once.

    merges: (grp, round, left, right, node, height, size); a node is named after its least leaf and the round, ``left`` has the
    lesser name and height is half the distance. roots: (grp, node, size, height, newick), one a group if all its pairs are there.
    Of equally near clusters the pair of lesser names merges. Names in Newick have their special characters replaced by _.
    """
    clean = F.regexp_replace("leaf", r"[\s()\[\]:;,']", "_")
    nodes = written(leaves.distinct().select("grp", F.col("leaf").alias("node"), F.col("leaf").alias("least"), F.lit(1).cast("long").alias("size"), F.lit(0.0).alias("height"), clean.alias("newick")), "nodes")
    links = written(pairs.where("i <> j").select("grp", F.col("i").alias("a"), F.col("j").alias("b"), F.col("d").cast("double").alias("s"), F.lit(1).cast("long").alias("n")), "links")
    merges, roots, n = None, None, 0
    while True:
        # Groups that have become small are finished where they are.
        few = nodes.groupBy("grp").count().where(F.col("count") <= SMALL).select("grp")
        own, rest = nodes.join(few, "grp", "left_semi"), nodes.join(few, "grp", "left_anti")
        done = written(own.groupBy("grp").cogroup(links.join(few, "grp", "left_semi").groupBy("grp")).applyInPandas(_finisher(n), _FINISHED), "finished")
        part = done.where("left IS NOT NULL").select("grp", "round", "left", "right", "node", "height", "size")
        merges = part if merges is None else merges.unionByName(part)
        part = done.where("left IS NULL").select("grp", "node", "size", "height", "newick")
        roots = part if roots is None else roots.unionByName(part)
        rest, more = written(rest, "nodes"), written(links.join(few, "grp", "left_anti"), "links")
        dropped(nodes, links)
        nodes, links = rest, more
        if nodes.isEmpty():
            return merges, roots.withColumn("newick", F.concat("newick", F.lit(";")))
        both = links.select("grp", F.explode(F.array("a", "b")).alias("node"), (F.col("s") / F.col("n")).alias("d"), F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right"))
        nearest = both.groupBy("grp", "node").agg(F.min(F.struct("d", "left", "right")).alias("near")).select("grp", "near.left", "near.right", "near.d")
        mutual = nearest.groupBy("grp", "left", "right").agg(F.count("*").alias("k"), (F.max("d") / 2).alias("h")).where("k = 2").drop("k")
        left = nodes.select("grp", *(F.col(c).alias(f"l_{c}") for c in nodes.columns[1:]))
        right = nodes.select("grp", *(F.col(c).alias(f"r_{c}") for c in nodes.columns[1:]))
        made = mutual.join(left.withColumnRenamed("l_node", "left"), ["grp", "left"]).join(right.withColumnRenamed("r_node", "right"), ["grp", "right"])
        branch = lambda side: F.concat(F.col(f"{side}_newick"), F.lit(":"), F.format_string("%.6f", F.greatest(F.col("h") - F.col(f"{side}_height"), F.lit(0.0))))
        least = F.least("l_least", "r_least")
        made = written(made.select("grp", F.lit(n).alias("round"), "left", "right", F.concat(least, F.lit(f"#{n}")).alias("node"), least.alias("least"), F.col("h").alias("height"), (F.col("l_size") + F.col("r_size")).alias("size"), F.concat(F.lit("("), branch("l"), F.lit(","), branch("r"), F.lit(")")).alias("newick")), "merges")
        if made.isEmpty():  # large groups whose pairs aren't all there
            roots = roots.unionByName(nodes.select("grp", "node", "size", "height", "newick"))
            return merges, roots.withColumn("newick", F.concat("newick", F.lit(";")))
        merges = merges.unionByName(made.select("grp", "round", "left", "right", "node", "height", "size"))
        renamed = made.select("grp", F.explode(F.array("left", "right")).alias("old"), F.col("node").alias("new"))
        gone = renamed.select("grp", F.col("old").alias("node"))
        stay = nodes.join(gone, ["grp", "node"], "left_anti").unionByName(made.select(*nodes.columns))
        now = links
        for side in ("a", "b"):
            to = renamed.select("grp", F.col("old").alias(side), F.col("new").alias("__new"))
            now = now.join(to, ["grp", side], "left").withColumn(side, F.coalesce("__new", side)).drop("__new")
        now = now.where("a <> b").select("grp", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "s", "n")
        old = nodes, links
        nodes, links = written(stay, "nodes"), written(now.groupBy("grp", "a", "b").agg(F.sum("s").alias("s"), F.sum("n").alias("n")), "links")
        dropped(*old)
        n += 1


SMALL = 400  # clusters of a group that a task finishes by itself: a matrix of 1.3 MB
_FINISHED = "grp string, round int, left string, right string, node string, height double, size long, newick string"


def _finisher(first: int):
    """The rest of a small group's merges, numbered on from ``first``, and then its roots (left is null)."""

    def run(nodes: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        state = {r.node: (r.least, int(r.size), float(r.height), r.newick) for r in nodes[["node", "least", "size", "height", "newick"]].itertuples(index=False, name="Node")}
        grp, names = nodes["grp"].iloc[0] if len(nodes) else None, sorted(state)
        at = {x: i for i, x in enumerate(names)}
        s, n = np.zeros((len(names), len(names))), np.zeros((len(names), len(names)))
        i, j = links["a"].map(at).to_numpy(dtype=int), links["b"].map(at).to_numpy(dtype=int)
        for x, y in ((i, j), (j, i)):
            s[x, y], n[x, y] = links["s"].to_numpy(), links["n"].to_numpy()
        out, number = [], first
        while True:
            with np.errstate(divide="ignore", invalid="ignore"):
                d = np.where(n > 0, s / n, np.inf)
            least = d.min() if d.size else np.inf
            if not np.isfinite(least):
                break
            pairs = [(min(names[x], names[y]), max(names[x], names[y]), x, y) for x, y in np.argwhere(d == least) if x < y]
            left, right, x, y = min(pairs)
            a, b, h = state.pop(left), state.pop(right), float(least) / 2
            node, first_leaf = f"{min(a[0], b[0])}#{number}", min(a[0], b[0])
            branch = lambda c: f"{c[3]}:{max(h - c[2], 0.0):.6f}"  # noqa: B023, E731
            state[node] = (first_leaf, a[1] + b[1], h, f"({branch(a)},{branch(b)})")
            out.append((grp, number, left, right, node, h, a[1] + b[1], None))
            for m in (s, n):
                m[x] += m[y]
                m[:, x] = m[x]
                m[x, x] = m[y] = m[:, y] = 0
            names[x] = node
            number += 1
        out += [(grp, number, None, None, node, c[2], c[1], c[3]) for node, c in sorted(state.items())]
        return pd.DataFrame(out, columns=["grp", "round", "left", "right", "node", "height", "size", "newick"])

    return run


def clusters(leaves: DataFrame, merges: DataFrame, most: float) -> DataFrame:
    """(grp, leaf, cluster): the clusters when only merges of a distance of ``most`` at most are made, named after the last node. Ways up
    the trees are halved in each round."""
    low = merges.where(F.col("height") * 2 <= most)
    up = written(low.select("grp", F.explode(F.array("left", "right")).alias("child"), F.col("node").alias("top")), "ways")
    while True:
        ahead = up.select("grp", F.col("child").alias("top"), F.col("top").alias("next"))
        longer = written(up.join(ahead, ["grp", "top"], "left").select("grp", "child", F.coalesce("next", "top").alias("top"), F.col("next").isNotNull().alias("moved")), "ways")
        dropped(up)
        up = longer.drop("moved")
        up._written = longer._written
        if longer.where("moved").isEmpty():
            break
    own = leaves.distinct().select("grp", "leaf").join(up.withColumnRenamed("child", "leaf"), ["grp", "leaf"], "left")
    return own.select("grp", "leaf", F.coalesce("top", "leaf").alias("cluster"))


def fractions_of(counts: DataFrame, *group: str, beta: float = 0.01) -> DataFrame:
    """(group, fractions): the share of each base at each place, from (group, pos, letter, cnt) with pos from 0; a share ``beta`` of
    uniform background is mixed in, places without a base are background. Letters other than bases don't count."""
    rows = counts.where(F.col("letter").isin(*BASES)).groupBy(*group, "pos").agg(*(F.coalesce(F.sum(F.when(F.col("letter") == b, F.col("cnt"))), F.lit(0)).cast("double").alias(b) for b in BASES))
    total = sum((F.col(b) for b in BASES), F.lit(0.0))
    share = lambda b: (F.col(b) / total + beta / 4) / (1 + beta)
    placed = rows.select(*group, "pos", F.array(*(share(b) for b in BASES)).alias("f")).groupBy(*group).agg(F.max("pos").alias("last"), F.map_from_entries(F.collect_list(F.struct("pos", "f"))).alias("m"))
    even = F.array(*(F.lit(0.25) for _ in BASES))
    return placed.select(*group, F.transform(F.sequence(F.lit(0), F.col("last").cast("int")), lambda i: F.coalesce(F.try_element_at("m", i), even)).alias("fractions"))


def in_families(motifs: DataFrame, family: Column, all_: str = "all") -> DataFrame:
    """(grp, id, fractions): each motif once in its family and once in the group of all."""
    return motifs.select(F.explode(F.array(family, F.lit(all_))).alias("grp"), "id", "fractions")


def cophenetic(merges: list[tuple[str, str, str, float]]) -> dict[tuple[str, str], float]:
    """{(leaf, leaf): height} of one group's merges (left, right, node, height) in order; a small helper to compare trees with."""
    members: dict[str, list[str]] = {}
    out = {}
    for left, right, node, height in merges:
        a, b = members.pop(left, [left]), members.pop(right, [right])
        out |= {(min(x, y), max(x, y)): height for x in a for y in b}
        members[node] = a + b
    return out

