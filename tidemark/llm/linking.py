"""Classes of linked nodes from postings, without comparing all members of a posting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import classes, discard, written

CROWD = 64  # members of a key from which on blocks are cheaper than pairs

Verify = Callable[[DataFrame], DataFrame]


def members_of(postings: DataFrame, name: str) -> DataFrame:
    """Postings (key, node, n, rank, index) of the keys that two nodes or more have, written."""
    keys = postings.groupBy("key").agg(F.count("*").alias("c"), F.max("index").alias("i")).where("c > 1 and i").select("key")
    return written(postings.join(keys, "key"), name)


def _ordered(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b), a < b, of pairs (u, un, ur, v, vn, vr) that can reach a similarity of ``percent``.

    Their sizes have to allow it, and what follows the key in both orders: a linked pair meets under its first common key too,
    before which neither has anything of the other, so it shares no more than the shorter rest.
    """
    fits = F.least("un", "vn") * 100 >= F.greatest("un", "vn") * percent
    fits &= F.least(F.col("un") - F.col("ur"), F.col("vn") - F.col("vr")) * (100 + percent) >= (F.col("un") + F.col("vn")) * percent
    return pairs.where(fits & (F.col("u") != F.col("v"))).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


def linked_classes(members: DataFrame, percent: int, verify: Verify, name: str, stars: int = 2, dense: Verify | None = None,
                   crowd: int = CROWD) -> DataFrame:
    """(node, root): classes of the links among nodes that share a key, root the smallest node.

    A link needs a key that both nodes have, one of them as the smaller (n, node) with ``index``; ``rank`` is the key's place, from 0, in the
    node's own part of one global order of keys. ``verify`` takes
    distinct candidates (a, b) and returns those that link. First every member is compared with one member of each key, the one for
    which the key is rarest (lowest rank), which a tight group all links to; then, where a key's members are in several classes,
    with another; what still is in different classes is compared pair by pair. Pairs within one class need no comparison, so the work
    follows the members of a posting, and its square only as far as they do not belong together. No pair is left out.

    With ``dense``, keys of which more than ``crowd`` members are left then do not become pairs: ``dense`` gets their (key, node, n) and returns
    links (a, b) that connect whatever links there.
    """
    links, checked, roots, spare = None, None, None, []
    for turn in range(stars + 1):
        open_ = members if roots is None else _open(members, roots)
        if turn:
            spare.append(open_)
            if open_.isEmpty():
                break
        if turn < stars:
            place = (F.struct("rank", "n", "node", F.col("node").alias("root")) if not turn
                     else F.struct(F.xxhash64("root", F.lit(turn)), "rank", "n", "node", "root"))
            centre = open_.groupBy("key").agg(F.min(place).alias("c"))
            pairs = open_.join(centre, "key").select(
                F.col("node").alias("u"), F.col("n").alias("un"), F.col("rank").alias("ur"), F.col("c.node").alias("v"), F.col("c.n").alias("vn"),
                F.col("c.rank").alias("vr"), F.col("root" if turn else "node").alias("x"), F.col("c.root").alias("y"))
            pairs = pairs.where("x <> y")
        else:
            if dense is not None:
                crowded = written(open_.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > crowd).select("key"), f"{name}-crowded")
                spare.append(crowded)
                if not crowded.isEmpty():
                    found = dense(open_.join(crowded, "key").select("key", "node", "n"))
                    spare.append(found)
                    links = links.unionByName(found)
                    open_ = open_.join(crowded, "key", "left_anti")
            small = open_.where("index").select("key", F.col("node").alias("v"), F.col("n").alias("vn"), F.col("rank").alias("vr"), F.col("root").alias("v_root"))
            pairs = (open_.select("key", F.col("node").alias("u"), F.col("n").alias("un"), F.col("rank").alias("ur"), "root").join(small, "key")
                     .where("root <> v_root and struct(vn, v) < struct(un, u)"))
        todo = _ordered(pairs, percent)
        if checked is not None:
            todo = todo.join(checked, ["a", "b"], "left_anti")
        todo = written(todo, f"{name}-pairs")
        spare.append(todo)
        checked = todo if checked is None else checked.unionByName(todo)
        found = verify(todo)
        # links of earlier turns are kept as class to class
        roots = written(classes(found if links is None else found.unionByName(links), f"{name}-classes"), f"{name}-roots")
        spare.append(roots)
        links = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    discard(*(table for table in spare if table is not roots))
    return roots


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members with their class, of the keys whose members are in two classes or more."""
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    keys = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    return written(rooted.join(keys, "key"), "open")
