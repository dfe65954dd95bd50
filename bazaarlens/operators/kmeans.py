"""One-dimensional k-means over prefix sums of points in global order.

Clusters of points on a line are intervals, cut halfway between neighbouring centers. With the sums of n, n*x and n*x*x
over everything below a cut, a round needs no pass over the points. The driver holds these sums for at most ``BLOCKS``
runs of points (and one more for each range of the global order), however many points there are; what a cut leaves of
the run it falls into is looked up in the written table, all cuts of a round together.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarlens.operators.ordering import Ordered

BLOCKS = 16_384


def start_positions(n: int, k: int) -> list[tuple[int, int, float]]:
    """Ranks (from 1) and weight that interpolate the quantiles spread over 0.1 .. 0.9."""
    spread = [0.1 + 0.8 * i / (k - 1) for i in range(k)] if k > 1 else [0.1]
    spots = []
    for q in spread:
        h = (n - 1) * q
        low = int(h)
        spots.append((low + 1, min(low + 2, n), h - low))
    return spots


class Line:
    """Points x with weights n, one row per distinct x, in global order."""

    def __init__(self, points: Ordered, blocks: int = BLOCKS):
        many = points.rows.count()
        per = max(1, -(-many // blocks))
        self.rows = points.rows.withColumn("_part", F.floor(F.col("_pos") / per))
        n, x = F.col("n"), F.col("x")
        sums = [F.sum(n).cast("double"), F.sum(n * x), F.sum(n * x * x)]
        held = self.rows.groupBy("_slot", "_part").agg(F.min(x).alias("low"), F.max(x).alias("high"), *[s.alias(f"s{i}") for i, s in enumerate(sums)])
        runs = sorted(held.collect(), key=lambda r: (r["_slot"], r["_part"]))
        self.keys = [(r["_slot"], r["_part"]) for r in runs]
        self.low, self.high = (np.array([r[name] for r in runs], float) for name in ("low", "high"))
        each = np.array([[r[f"s{i}"] for i in range(3)] for r in runs], float).reshape(-1, 3)
        self.before = np.vstack([np.zeros(3), np.cumsum(each, 0)])
        self.lookups = 0

    @property
    def all(self) -> np.ndarray:
        """Sums of n, n*x, n*x*x over all points."""
        return self.before[-1]

    def upto(self, cuts: list[float]) -> np.ndarray:
        """The three sums over all points up to each cut, points on it included."""
        place = np.searchsorted(self.high, cuts, "right")
        out = self.before[place].copy()
        inside = [i for i, (p, cut) in enumerate(zip(place, cuts, strict=True)) if p < len(self.low) and self.low[p] <= cut]
        if inside:
            self.lookups += 1
            spots = sorted({int(place[i]) for i in inside})
            near = reduce(Column.__or__, [F.col("x").between(float(self.low[p]), float(self.high[p])) for p in spots])
            n, x, cells = F.col("n"), F.col("x"), []
            for i in inside:
                own = (x >= float(self.low[place[i]])) & (x <= float(cuts[i]))
                cells += [F.coalesce(F.sum(F.when(own, v)), F.lit(0)).cast("double") for v in (n, n * x, n * x * x)]
            found = self.rows.filter(near).agg(*[v.alias(f"c{i}") for i, v in enumerate(cells)]).first()
            out[inside] += np.array(found, float).reshape(-1, 3)
        return out

    def at_ranks(self, points: Ordered, ranks: list[int]) -> dict[int, float]:
        """x of the points that hold these ranks (from 1), every point counted n times."""
        wanted = F.array(*[F.lit(r).cast("bigint") for r in ranks])
        upto = F.col("running_value").cast("bigint")
        own = F.filter(wanted, lambda r: (r <= upto) & (r > upto - F.col("n")))
        found = points.running("n").select("x", F.explode(own).alias("rank")).collect()
        return {r["rank"]: r["x"] for r in found}


def clusters(centers: list[float], upto: dict[float, np.ndarray], everything: np.ndarray) -> np.ndarray:
    """The three sums of each cluster; of equal centers the first has all points."""
    held = np.zeros((len(centers), 3))
    cuts, last = sorted(set(centers)), np.zeros(3)
    for i, center in enumerate(cuts):
        sums = upto[halfway(center, cuts[i + 1])] if i + 1 < len(cuts) else everything
        held[centers.index(center)], last = sums - last, sums
    return held


def halfway(a: float, b: float) -> float:
    return a + (b - a) / 2


def lloyd(line: Line, starts: dict[int, list[float]], rounds: int = 50) -> dict[int, tuple[float, bool]]:
    """Within-cluster variance and whether the centers came to rest, for each k in ``starts`` (ascending centers).

    A round cuts the line for all k still moving at once. A k stops when no center moves (relative 1e-5, absolute 1e-8);
    an empty cluster keeps its center. Points are labelled by the centers before the last move.
    """
    centers, labelled_by, moving = dict(starts), dict(starts), set(starts)

    def summed(held: dict[int, list[float]]) -> dict[int, np.ndarray]:
        cuts = sorted({halfway(a, b) for c in held.values() for s in [sorted(set(c))] for a, b in zip(s[:-1], s[1:], strict=True)})
        upto = dict(zip(cuts, line.upto(cuts), strict=True)) if cuts else {}
        return {k: clusters(c, upto, line.all) for k, c in held.items()}

    for _ in range(rounds):
        if not moving:
            break
        for k, sums in summed({k: centers[k] for k in moving}).items():
            labelled_by[k] = centers[k]
            found = [float(s[1] / s[0]) if s[0] else held for s, held in zip(sums, centers[k], strict=True)]
            if all(abs(a - b) <= 1e-8 + 1e-5 * abs(b) for a, b in zip(found, centers[k], strict=True)):
                moving.discard(k)
            else:
                centers[k] = found
    out = {}
    for k, sums in summed(labelled_by).items():
        c = np.array(centers[k])
        out[k] = (max(0.0, float((sums[:, 2] - 2 * c * sums[:, 1] + c * c * sums[:, 0]).sum())), k not in moving)
    return out
