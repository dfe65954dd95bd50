"""Embedding near-dedup over a robust-pruned flat graph.

Equal vectors of a label are one point. Points are dealt to shards: centres are a bounded sample of a label's points,
thinned so that a crowd of near copies does not bring many centres that all its points are near to, and a point goes to
the shards of its ``OVERLAP`` nearest centres. A task builds a graph on each shard: candidates of a
point are robustly pruned, so that a kept neighbour is not much nearer to an earlier kept one than to the point. A
point's lists from all its shards are united, and every shard gets the united lists of its points. There points are
looked for by greedy search from the shard's medoid, also in shards whose centre is within ``ROUTE``; once the beam has reached the point's neighbourhood, the search
goes on along every edge from points within range, until nothing within range is new. Each hit is verified in double
precision. Shards have a bounded expected size, as the number of centres follows the number of points; a shard that
grows beyond ``LIMIT`` (a crowd of nearly equal points) is split at random into parts, and each part is searched for the
points of each part: no hit is lost, and no task holds more members, or asks for more points, than that.

Counts of links are summed over shards; a pair that meets in two shards counts in the first of them only. For the
components a task hands on a spanning forest of what it found, never pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.components import components
from bazaarlens.session import prefer_skew_handling, write_out

LEAST = 0.98
OVERLAP = 2
SHARD = 512  # points for each centre
CENTRES = 4096  # most centres of a label
APART = 0.95  # of centres that are nearer to each other one is left
LIMIT = 8192  # points of a shard that a task holds
ROUTE = 0.82  # a point is also looked for in all shards whose centre is that near: 0.6, three times the range of 0.98
DEGREE = 24
ALPHA = 1.2
BEAM = 32


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    # scaled by a power of two, so that no square overflows or vanishes
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(1, keepdims=True))[1])
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def robust_prune(near: np.ndarray, distance: np.ndarray, vectors: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Of candidates in order of their distance to a point: each kept one removes those that it is much nearer to."""
    own = vectors[near]
    between = ALPHA * np.maximum(0, 2 - 2 * (own @ own.T))
    kept, open_ = [], np.ones(len(near), bool)
    while len(kept) < degree and open_.any():
        i = int(np.argmax(open_))
        kept.append(near[i])
        open_ &= between[i] > distance
        open_[i] = False
    return np.array(kept, np.int64)


def shard_graph(vectors: np.ndarray, candidates: int = 64) -> list[np.ndarray]:
    """Pruned neighbours of each point, with the edges back; the candidates are the nearest points of the shard."""
    n = len(vectors)
    lists: list[np.ndarray] = []
    for at in range(0, n, 256):
        distance = np.maximum(0, 2 - 2 * (vectors[at : at + 256] @ vectors.T))
        k = min(candidates + 1, n)
        near = np.argpartition(distance, k - 1, 1)[:, :k]
        for row, some in enumerate(near):
            some = some[some != at + row]
            # a few far points keep the graph in one piece
            far = (np.arange(1, 5) * (n // 5 + 1) + at + row) % n
            some = np.unique(np.r_[some, far[far != at + row]])
            own = distance[row, some]
            order = np.argsort(own, kind="stable")
            lists.append(robust_prune(some[order], own[order], vectors))
    back: list[list[int]] = [[] for _ in range(n)]
    for i, own in enumerate(lists):
        for j in own.tolist():
            back[j].append(i)
    return [np.union1d(own, np.array(b[: 2 * DEGREE], np.int64)) if b else own for own, b in zip(lists, back, strict=True)]


def range_search(vectors: np.ndarray, graph: list[np.ndarray], start: int, query: np.ndarray, least: float) -> np.ndarray:
    """Points with a cosine of at least ``least``, in any order: greedy search, then along all edges within range."""
    seen = np.zeros(len(vectors), bool)
    seen[start] = True
    beam, cosine, done = np.array([start]), vectors[[start]] @ query, np.zeros(1, bool)
    while not done.all():
        # all that is within range at once, else the best
        open_ = np.flatnonzero(~done & (cosine >= least))
        if not len(open_):
            open_ = np.array([np.argmax(np.where(done, -2.0, cosine))])
        done[open_] = True
        new = np.unique(np.concatenate([graph[i] for i in beam[open_]]))
        new = new[~seen[new]]
        seen[new] = True
        beam, cosine = np.r_[beam, new], np.r_[cosine, vectors[new] @ query]
        done = np.r_[done, np.zeros(len(new), bool)]
        if len(beam) > BEAM:
            # whatever is in range stays; of the rest the best
            keep = np.zeros(len(beam), bool)
            keep[np.argpartition(-cosine, BEAM - 1)[:BEAM]] = True
            keep |= cosine >= least
            beam, cosine, done = beam[keep], cosine[keep], done[keep]
    return beam[cosine >= least]


def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, x: rows that can link at all."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    known = vectors.select(F.col("vec_id").cast("long"), "label", x.alias("x"))
    return known.where("vec_id is not null and label is not null and x is not null").where(F.size("x") > 0).where(finite)


def _assigned(points: pa.Table, centres: pa.Table) -> pa.Table:
    """Each point of a part of a label with the shards it is looked for in, nearest first, one row for each; it lives
    in the first ``OVERLAP`` of them (``home``)."""
    x = unit(np.array(points["x"].to_pylist()))
    c = unit(np.array(centres["c_x"].to_pylist()))
    names = centres["c_rep"].to_numpy()
    order = np.argsort(names)
    c, names = c[order], names[order]
    k = min(OVERLAP, len(names))
    rows, routes, homes, home = [], [], [], []
    for at in range(0, len(x), 1024):
        cosine = x[at : at + 1024] @ c.T
        order = np.argsort(-cosine, 1, kind="stable")
        close = (cosine >= ROUTE).sum(1)
        for i, n in enumerate(np.maximum(k, close).tolist()):
            route = names[order[i, :n]].tolist()
            rows += [at + i] * n
            routes += route
            homes += [route] * n
            home += [True] * k + [False] * (n - k)
    row = pa.array(rows, pa.int64())
    return pa.table(
        {
            "shard": pa.array(routes, pa.int64()),
            "rep": points["rep"].take(row),
            "route": pa.array(homes, pa.list_(pa.int64())),
            "home": pa.array(home, pa.bool_()),
            "x": points["x"].take(row),
            "copies": points["copies"].take(row),
        }
    )


def _thinned(centres: pa.Table) -> pa.Table:
    """Centres of a label without those that are close to one of a smaller hash."""
    c = unit(np.array(centres["x"].to_pylist()))
    order = np.lexsort((centres["rep"].to_numpy(), centres["luck"].to_numpy()))
    kept: list[int] = []
    for i in order.tolist():
        if not kept or (c[kept] @ c[i]).max() < APART:
            kept.append(i)
    return centres.take(pa.array(kept, pa.int64())).select(["label", "dim", "rep", "x"])


def to_shards(points: DataFrame) -> DataFrame:
    """shard, rep, route, home, x, copies, part, parts: points in the shards of their nearest centres."""
    sizes = points.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("first"))
    shares = sizes.select("label", "dim", "first", "n", (F.least(F.ceil(F.col("n") / SHARD), F.lit(CENTRES)) / F.col("n")).alias("share"))
    marked = points.join(shares, ["label", "dim"])
    luck = F.pmod(F.xxhash64("rep", F.lit("centre")), F.lit(1 << 30)) / float(1 << 30)
    pieces = F.ceil(F.col("n") / 4096).cast("int")
    marked = marked.withColumn("pieces", pieces).withColumn("piece", F.pmod(F.xxhash64("rep"), pieces).cast("int"))
    drawn = marked.where((luck < F.col("share")) | (F.col("rep") == F.col("first"))).select("label", "dim", "rep", "x", luck.alias("luck"))
    kind = ", ".join(f"{n} {t}" for n, t in points.select("label", "dim", "rep", "x").dtypes)
    centres = write_out(drawn.groupBy("label", "dim").applyInArrow(_thinned, kind), "centres")  # about CENTRES rows a label at most
    every = F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / 4096).cast("int") - 1)).alias("c_piece")
    centres = centres.join(sizes.select("label", "dim", "n"), ["label", "dim"])
    centres = centres.select(every, *[F.col(c).alias(f"c_{c}") for c in ("label", "dim", "rep", "x")])
    key = ["label", "dim", "piece"]
    kind = "shard long, rep long, route array<long>, home boolean, x array<double>, copies long"
    dealt = marked.select(*key, "rep", "x", "copies").groupBy(*key).cogroup(centres.groupBy(*[f"c_{c}" for c in key])).applyInArrow(_assigned, kind)
    dealt = write_out(dealt, "graph-shards")
    parts = dealt.where("home").groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / LIMIT).cast("int").alias("parts"))
    return dealt.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("rep", F.lit("part")), F.col("parts")).cast("int"))


def _built(table: pa.Table) -> pa.Table:
    reps = table["rep"].to_numpy()
    graph = shard_graph(unit(np.array(table["x"].to_pylist())))
    return pa.table({"rep": table["rep"], "near": pa.array([reps[g].tolist() for g in graph], pa.list_(pa.int64()))})


def _searched(least: float):
    def shard(table: pa.Table) -> pa.Table:
        """Links of the shard's queries: (a, NULL, n) counts a query's links, (a, b, NULL) are links of a forest."""
        rep, x = table["rep"].to_numpy(), unit(np.array(table["x"].to_pylist()))
        routes, copies = table["route"].to_pylist(), table["copies"].to_numpy()
        homes = np.array([(r * OVERLAP)[:OVERLAP] for r in routes])
        is_member = table["is_member"].to_numpy(zero_copy_only=False)
        member = np.flatnonzero(is_member)
        if not len(member):
            return pa.table({k: pa.array([], pa.int64()) for k in ("a", "b", "n")})
        order = member[np.argsort(rep[member])]
        names, vectors = rep[order], x[order]
        lists = table["near"].to_pylist()
        graph = []
        for i in order.tolist():
            near = np.array(lists[i] or [], np.int64)
            at = np.minimum(np.searchsorted(names, near), len(names) - 1)
            graph.append(at[names[at] == near])
        medoid = int(np.argmax(vectors @ vectors.mean(0)))
        shard = table["shard"][0].as_py()
        part = np.arange(len(rep))  # the component of each row, as far as this task has seen
        counted: dict[int, int] = {}
        forest = []
        for q in np.flatnonzero(table["is_query"].to_numpy(zero_copy_only=False)).tolist():
            hits = order[range_search(vectors, graph, medoid, x[q], least)]
            hits = hits[rep[hits] != rep[q]]
            earlier = routes[q][: routes[q].index(shard)]  # a pair counts in the first shard that has both
            n = int(copies[hits[~np.isin(homes[hits], earlier).any(1)]].sum()) if earlier else int(copies[hits].sum())
            if n:
                counted[int(rep[q])] = counted.get(int(rep[q]), 0) + n
            kinds, at = np.unique(part[hits], return_index=True)
            for kind, h in zip(kinds.tolist(), hits[at].tolist(), strict=True):
                if kind != part[q]:
                    forest.append((int(rep[q]), int(rep[h])))
                    part[part == kind] = part[q]
        rows = [(a, None, n) for a, n in counted.items()] + [(a, b, None) for a, b in forest]
        return pa.table({k: pa.array([r[i] for r in rows], pa.int64()) for i, k in enumerate(("a", "b", "n"))})

    return shard


def near_dedup(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and their cosine is at least ``least``. Vectors that are NULL, empty or zero
    or hold a NULL or non-finite component link with nothing, nor do rows with a NULL label or vec_id, nor vectors of
    different lengths. Rows that repeat a vec_id are vectors of their own for the counts. Other columns are ignored, an
    empty table gives no rows.
    """
    prefer_skew_handling(vectors.sparkSession)
    usable = write_out(_usable(vectors), "usable-vectors")
    groups = usable.groupBy("label", "x").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    points = write_out(groups.withColumn("dim", F.size("x")), "points")
    shards = write_out(to_shards(points), "shard-parts")
    graph = shards.where("home").groupBy("shard", "part").applyInArrow(_built, "rep long, near array<long>")
    united = write_out(graph.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
    members = shards.join(united, "rep")
    # a row asks in a task for each part, and is a member in a task for each asking part; in its own part it is both
    each = F.sequence(F.lit(0), F.col("parts") - 1)
    asks = F.transform(each, lambda t: F.struct(F.col("part").alias("by"), t.alias("to"), F.lit(True).alias("is_query")))
    lies = F.transform(F.filter(each, lambda b: F.col("home") & (b != F.col("part"))), lambda b: F.struct(b.alias("by"), F.col("part").alias("to"), F.lit(False).alias("is_query")))
    asked = members.select("*", F.inline(F.concat(asks, lies))).withColumn("is_member", F.col("home") & (F.col("part") == F.col("to")))
    found = asked.groupBy("shard", "by", "to").applyInArrow(_searched(least), "a long, b long, n long")
    found = write_out(found, "found-links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    near = write_out(components(found.where("b is not null"), "vectors"), "vector-components")

    told = points.join(counts, points["rep"] == counts["a"], "left").join(near, points["rep"] == near["node"], "left")
    told = told.select("label", "x", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("own"))
    linked = usable.join(told.where("n_links > 0"), ["label", "x"]).select("vec_id", "n_links", "own").distinct()
    out = vectors.select(F.col("vec_id").cast("long"), "label").join(linked, "vec_id", "left")
    component = F.coalesce("own", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))


def audit(vectors: DataFrame, result: DataFrame, every: int = 100, least: float = LEAST) -> DataFrame:
    """found, there: links of the vectors whose vec_id ``every`` divides, as found and by comparison with all rows."""
    usable = _usable(vectors).withColumn("norm", F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)))
    some = usable.where(F.col("vec_id") % every == 0).select(*[F.col(c).alias(f"q_{c}") for c in ("vec_id", "label", "x", "norm")])
    pairs = some.join(usable, (F.col("label") == F.col("q_label")) & (F.col("vec_id") != F.col("q_vec_id")) & (F.size("x") == F.size("q_x")))
    dot = F.aggregate(F.zip_with("x", "q_x", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    there = pairs.where(dot / (F.col("norm") * F.col("q_norm")) >= least).agg(F.count(F.lit(1)).alias("there"))
    return result.where(F.col("vec_id") % every == 0).agg(F.sum("n_links").alias("found")).crossJoin(there)  # one row each
