"""Connected components of link tables, without gathering them anywhere."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.workspace import materialise

LINKS_A_FILE = 200_000


class Forest:
    """Disjoint sets of the 64-bit `ids` inside one task, joined many pairs at a time."""

    def __init__(self, ids: np.ndarray) -> None:
        self.ids = np.unique(ids)
        self.label = np.arange(len(self.ids))

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = np.searchsorted(self.ids, a), np.searchsorted(self.ids, b)
        while True:
            a, b = self.label[a], self.label[b]
            apart = a != b
            a, b = a[apart], b[apart]
            if not len(a):
                return
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while (up := self.label[self.label]).tobytes() != self.label.tobytes():
                self.label = up

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Each member with its set's smallest id, the smallest itself left out."""
        rest = np.flatnonzero(self.label != np.arange(len(self.ids)))
        return self.ids[rest], self.ids[self.label[rest]]


def component_of(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is the smallest node.

    Alternating large-star and small-star (Kiveris et al. 2014): every node links
    its larger, then its smaller neighbours to the smallest node it knows, until
    all links are stars. A round is partial minima and a plain join, whose hot
    centres adaptive execution splits; each round is a written table, so a lost
    executor costs no more than the round. Self-links and repeats are harmless, an
    empty table gives none. Links of a hot centre never meet in one task.
    """
    links = materialise(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    for _ in range(max_rounds):
        state = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(state) == before or not state[0]:
            # in stars every other node has one link, so only the centres repeat
            centres = links.select("b").distinct().selectExpr("b as node", "b as component")
            return links.selectExpr("a as node", "b as component").union(centres)
        before = tuple(state)
        # links never become more, so a file for so many is a bound on a task's rows
        files = 1 + state[0] // LINKS_A_FILE
        # large-star: a larger neighbour of u goes to the smallest of u and its neighbours
        both = links.union(links.selectExpr("b as a", "a as b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr(
            "a as u", "least(a, m) as m"
        )
        large = (
            both.where("b > a").join(least, F.col("a") == F.col("u"))
            .selectExpr("b as a", "m as b").distinct()
        )
        # small-star: u and its smaller neighbours go to the smallest of them
        small = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        moved = large.join(small, F.col("a") == F.col("u")).selectExpr(
            "if(b = m, a, b) as a", "m as b"
        )
        links = materialise(
            moved.union(small.selectExpr("u as a", "m as b"))
            .where("a <> b")
            .distinct()
            .coalesce(files),
            "links",
        )
    raise RuntimeError(f"links did not settle in {max_rounds} rounds")
