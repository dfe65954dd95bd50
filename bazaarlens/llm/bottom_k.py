"""MinHash near-dedup with bottom-k sketches from one hash function.

A document's set is its distinct shingles; its sketch the ``SKETCH`` least of their hashes, from one function. Documents
with equal sets are one class and go on as one. Values of the sketches that a class shares with another make inverted
lists, and a class stands in the lists of its rarest values only: two sets with a Jaccard of 0.8 share at least
``LEAST_SHARED`` values of their sketches, so they must meet in one of the first ``SKETCH - LEAST_SHARED + 1``
(chance of missing a pair, see ``LEAST_SHARED``, about 1 in 10**8; sets that are no longer than a sketch miss nothing).

All classes of a list are compared with the list's hub, the class with the fewest values of its own: copies of one
original meet it there. A comparison first estimates by the sketch of the union, then confirms on the full sets. Classes
that share a hub are its family. Where a family is still in several components, those outside the hub's component are
compared with the whole family, in blocks of about ``BLOCK`` classes: first by sketches, which says of each class whether
it has a candidate at all, then, for classes that have, by full sets. Blocks hand on classes and at most one link a class,
never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.components import components
from bazaarlens.llm.words import U, Words, combine, mix, parts, rolled
from bazaarlens.session import prefer_skew_handling, write_out

SKETCH = 64
#: Of the union's 64 least values at least 80 % in the mean lie in both sets; fewer than 32 do once in 10**8 pairs.
LEAST_SHARED = 32
NUMERATOR, DENOMINATOR = 80, 100  # the least Jaccard
BLOCK = 1024  # classes of a family that are in a task's memory together, on each side


def shingle_sets(text: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes, sorted; fewer words than ``width`` are one shingle, none are none."""
    words = Words(text)
    numbers = words.numbers(lower=True)
    whole = rolled(numbers, width)
    for first, n in zip(words.first.tolist(), words.counts.tolist(), strict=True):
        if n >= width:
            own = np.sort(whole[first : first + n - width + 1])
            yield own[np.r_[True, own[1:] != own[:-1]]]
        elif n:
            out = np.array([n], U)
            for k in range(n):
                out = combine(out, numbers[first + k : first + k + 1])
            yield out
        else:
            yield np.zeros(0, U)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, set_print (128 bits of the set), sketch (ascending; as signed numbers)."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                size, prints, lists = [], [], []
                for own in shingle_sets(part["text"], width):
                    size.append(len(own))
                    prints.append(np.array([mix(own).sum(), mix(own ^ U(0xB5AD4ECEDA1CE2A9)).sum()], U).tobytes())
                    lists.append(own[:SKETCH].view(np.int64))
                offsets = np.cumsum([0, *map(len, lists)])
                sketch = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*lists, np.zeros(0, np.int64)])))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(size, pa.int64()), pa.array(prints, pa.binary()), sketch],
                    ["doc_id", "n_shingles", "set_print", "sketch"],
                )

    kind = "doc_id long, n_shingles long, set_print binary, sketch array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sketched, kind)


def _least_shared(n: Column) -> Column:
    """Values that the sketch of a set of n has in common with that of any similar set, at least."""
    exact = F.ceil(n * NUMERATOR / DENOMINATOR)
    return F.when(n * DENOMINATOR <= SKETCH * NUMERATOR, exact).otherwise(LEAST_SHARED)


def inverted_lists(classes: DataFrame) -> DataFrame:
    """value, rep, n, own: each class in the lists of its rarest shared values; ``own`` counts its unshared values."""
    entries = classes.select("rep", "n", F.explode("sketch").alias("value"))
    shared = entries.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    met = entries.join(shared, "value").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("met"))
    size = F.least(F.col("n"), F.lit(SKETCH))
    own = size - F.size("met")
    first = size - _least_shared(F.col("n")) + 1 - own  # values that nobody shares are the rarest and come first
    listed = met.select("rep", "n", own.alias("own"), F.slice("met", F.lit(1), F.greatest(first, F.lit(0)).cast("int")).alias("met"))
    return listed.select("rep", "n", "own", F.explode("met.value").alias("value"))


def _could_match(n_a: Column, n_b: Column) -> Column:
    return (n_a * DENOMINATOR >= n_b * NUMERATOR) & (n_b * DENOMINATOR >= n_a * NUMERATOR)


def _linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, label: str) -> DataFrame:
    """Of pairs (a, b) of classes, those that are similar: first by their sketches, then by their full sets."""
    sketch = classes.select("rep", "sketch")
    pairs = pairs.join(sketch.select(F.col("rep").alias("a"), F.col("sketch").alias("sketch_a")), "a")
    pairs = pairs.join(sketch.select(F.col("rep").alias("b"), F.col("sketch").alias("sketch_b")), "b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, SKETCH)
    both = F.size(F.array_intersect(F.array_intersect("sketch_a", "sketch_b"), union))
    likely = both * SKETCH >= F.size(union) * LEAST_SHARED
    pairs = write_out(pairs.where(likely).select("a", "b"), f"{label}-likely")
    text = docs.select("doc_id", "text")
    full = pairs.join(text.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    full = full.join(text.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text_a"):
                keep = []
                for a, b in zip(shingle_sets(part["text_a"], width), shingle_sets(part["text_b"], width), strict=True):
                    inside = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(inside > 0 and DENOMINATOR * inside >= NUMERATOR * (len(a) + len(b) - inside))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return full.select("a", "b", "text_a", "text_b").mapInArrow(confirmed, "a long, b long")


def _blocks(members: DataFrame, buckets: int) -> DataFrame:
    """hub, rep, outside, component, n with the blocks (at) in which a class is compared, once for each side.

    ``members`` has families in several components. Classes outside the hub's component are the left side, all are
    the right side; a family's sides are dealt to blocks by a hash, and each left block meets each right block.
    """
    counts = members.groupBy("hub").agg(F.count(F.lit(1)).alias("all"), F.count_if("outside").alias("out"))
    sized = members.join(counts.where("out > 0"), "hub")
    lefts, rights = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("out", "all"))
    left, right = F.pmod(F.xxhash64("rep", F.lit("left")), lefts), F.pmod(F.xxhash64("rep", F.lit("right")), rights)
    own = sized.withColumns({"left": left, "right": right})
    columns = ["hub", "rep", "component", "n"]
    one = own.where("outside").select(*columns, F.lit(True).alias("is_left"), "left", F.explode(F.sequence(F.lit(0), rights - 1)).alias("right"))
    two = own.select(*columns, F.lit(False).alias("is_left"), F.explode(F.sequence(F.lit(0), lefts - 1)).alias("left"), "right")
    both = one.select(*columns, "is_left", F.col("left").cast("int"), F.col("right").cast("int")).unionByName(
        two.select(*columns, "is_left", F.col("left").cast("int"), F.col("right").cast("int"))
    )
    return both.withColumn("bucket", F.pmod(F.xxhash64("hub", "left", "right"), F.lit(buckets)).cast("int"))


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For some left sets at a time: the place of the first, and how many values each shares with each right set."""
    sizes = np.array([len(x) for x in right])
    values, owner = np.concatenate(right), np.repeat(np.arange(len(right)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    at = 0
    while at < len(left):
        some, found = [], 0
        while at + len(some) < len(left) and (not some or found < 1_000_000):
            own = left[at + len(some)]
            low, high = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
            some.append((low, high - low))
            found += int((high - low).sum())
        low, size = np.concatenate([x[0] for x in some]), np.concatenate([x[1] for x in some])
        row = np.repeat(np.repeat(np.arange(len(some)), [len(x[0]) for x in some]), size)
        place = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        yield at, np.bincount(row * len(right) + owner[place], minlength=len(some) * len(right)).reshape(len(some), len(right))
        at += len(some)


def _matches(table: pa.Table, sets: list[np.ndarray], exact: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(row, matching rows of the other side) for the left rows of each block of a bucket."""
    hub, left, right = (table[c].to_numpy() for c in ("hub", "left", "right"))
    side, component, n = table["is_left"].to_numpy(zero_copy_only=False), table["component"].to_numpy(), table["n"].to_numpy()
    order = np.lexsort((right, left, hub))
    new = np.r_[True, (hub[order][1:] != hub[order][:-1]) | (left[order][1:] != left[order][:-1]) | (right[order][1:] != right[order][:-1])]
    cuts = np.r_[np.flatnonzero(new), len(order)].tolist()
    need = np.where(n * DENOMINATOR <= SKETCH * NUMERATOR, -(-n * NUMERATOR // DENOMINATOR), LEAST_SHARED)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = order[a:b]
        one, two = own[side[own]], own[~side[own]]
        if not len(one) or not len(two):
            continue
        for at, shared in _shared([sets[i] for i in one], [sets[i] for i in two]):
            rows = one[at : at + len(shared)]
            na, nb = n[rows][:, None], n[two][None, :]
            if exact:
                good = (shared > 0) & (DENOMINATOR * shared >= NUMERATOR * (na + nb - shared))
            else:
                good = (shared >= np.maximum(need[rows][:, None], need[two][None, :])) & (na * DENOMINATOR >= nb * NUMERATOR)
                good &= nb * DENOMINATOR >= na * NUMERATOR
            good &= component[rows][:, None] != component[two][None, :]
            for k in np.flatnonzero(good.any(1)).tolist():
                yield int(rows[k]), two[good[k]]


def _with_candidates(table: pa.Table) -> pa.Table:
    """Classes of a bucket that have a candidate by their sketches."""
    sets = [np.asarray(x.values) for x in table["sketch"].combine_chunks()] if len(table) else []
    rep, found = table["rep"].to_numpy(), set()
    for row, others in _matches(table, sets, exact=False):
        found.add(int(rep[row]))
        found.update(rep[others].tolist())
    return pa.table({"rep": pa.array(sorted(found), pa.int64())})


def _confirmed(width: int):
    def bucket(table: pa.Table) -> pa.Table:
        """Links of a bucket by full sets, a spanning forest of them."""
        sets = list(shingle_sets(table["text"].combine_chunks(), width))
        rep, parent = table["rep"].to_numpy(), {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        links = []
        for row, others in _matches(table, sets, exact=True):
            for other in rep[others].tolist():
                a, b = root(int(rep[row])), root(other)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    links.append((int(rep[row]), other))
        return pa.table({k: pa.array([x[i] for x in links], pa.int64()) for i, k in enumerate("ab")})

    return bucket


def near_dedup(docs: DataFrame, width: int = 4) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Words are compared with A-Z as a-z. NULL texts and texts without words have an empty set and are linked with
    nothing, not even each other. Rows with a NULL doc_id are linked with nothing, their component_id is NULL and they
    are kept. Rows that repeat a doc_id with the same text get the same answer each; with different texts a doc_id is
    one node, compared by its text of most shingles. Other columns are ignored, an empty table gives no rows.
    """
    prefer_skew_handling(docs.sparkSession)
    found = write_out(sketches(docs, width), "sketches")
    known = found.where("doc_id is not null and n_shingles > 0")
    firsts = known.groupBy("set_print").agg(F.min(F.struct("doc_id", F.col("n_shingles").alias("n"), "sketch")).alias("c"))
    classes = write_out(firsts.select("set_print", F.col("c.doc_id").alias("rep"), "c.n", "c.sketch"), "classes")
    lists = write_out(inverted_lists(classes), "inverted-lists")

    hubs = lists.groupBy("value").agg(F.min(F.struct("own", "rep", "n")).alias("hub"), F.count(F.lit(1)).alias("long")).where("long > 1")
    families = lists.join(hubs, "value").select(F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n"), "rep", "n").distinct()
    families = write_out(families, "families")
    star = families.where("rep <> hub").where(_could_match(F.col("n"), F.col("hub_n"))).select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    links = write_out(_linked(star, classes, docs, width, "star"), "star-links")
    near = write_out(components(links, "star"), "star-components")

    placed = families.join(near.withColumnRenamed("node", "rep"), "rep", "left")
    of_hub = near.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    placed = placed.join(of_hub, "hub", "left").withColumn("component", F.coalesce("component", "rep"))
    placed = placed.withColumn("outside", F.col("component") != F.coalesce("hub_component", "hub"))
    placed = write_out(placed.select("hub", "rep", "n", "component", "outside"), "placed")
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = _blocks(placed, buckets).join(classes.select("rep", "sketch"), "rep")
    asked = write_out(blocks.groupBy("bucket").applyInArrow(_with_candidates, "rep long").distinct(), "asked")
    blocks = _blocks(placed.join(asked, "rep", "left_semi"), buckets)
    blocks = blocks.join(docs.select(F.col("doc_id").cast("long").alias("rep"), "text"), "rep")
    more = write_out(blocks.groupBy("bucket").applyInArrow(_confirmed(width), "a long, b long"), "family-links")
    near = write_out(components(links.unionByName(more), "near"), "near-components")

    named = classes.join(near.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("set_print", F.coalesce("component", "rep").alias("component"))
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    out = found.drop("sketch").join(named, "set_print", "left")
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))
