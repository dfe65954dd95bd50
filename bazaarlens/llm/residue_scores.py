"""Hard negatives from exact integer scores, computed in a residue number system.

Rows are laid out in cells by label. A task multiplies its anchors' and rows' components modulo several small primes, in
single precision: with symmetric residues and ``CHUNK`` components at a time every sum stays below 2**24, so each product
is exact. As many primes are used as the lengths of the vectors ask for; the scores come back, signed and exact, by
Chinese remaindering in mixed radix.

First each anchor meets the cells that hold its label and finds its positives. Then it meets all cells, and for each
positive the best rows of other labels inside the positive's window of scores are selected, per cell and then over all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.vectors import in_blocks, in_cells, matrix, meet, whole_numbers
from bazaarlens.session import prefer_skew_handling, write_out

CHUNK = 64  # components in one single-precision sum: 64 * 510 * 510 < 2**24
ROWS = 256  # anchors scored together


def _primes(n: int) -> list[int]:
    """The n largest primes below 2 * 510 + 2."""
    found, p = [], 1021
    while len(found) < n:
        if all(p % d for d in range(2, int(p**0.5) + 1)):
            found.append(p)
        p -= 2
    return found


#: Seven of them have a product of over 2**69, for any score below 2**62.
PRIMES = _primes(7)


def primes_for(most: float) -> list[int]:
    """As few primes as tell all whole numbers from -most to most apart, with room for a sign by a rounded quotient."""
    product, used = 1, []
    for p in PRIMES:
        used.append(p)
        product *= p
        if product > 8 * (most + 1):
            return used
    raise ValueError("scores beyond 64 bits")


def residues(q: np.ndarray, p: int) -> np.ndarray:
    """Symmetric residues, at most (p - 1) / 2 in size, in single precision."""
    r = q % p
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def modular(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """Products of all rows of both modulo p; a and b hold residues."""
    out = np.zeros((len(a), len(b)), np.int32)
    for at in range(0, a.shape[1], CHUNK):
        out += (a[:, at : at + CHUNK] @ b[:, at : at + CHUNK].T).astype(np.int32) % p
        out %= p
    return out


def signed(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The whole numbers with these residues, from minus to plus half the product of the primes, as 64-bit numbers."""
    digits = [parts[0].astype(np.int64)]
    for i in range(1, len(primes)):
        p = primes[i]
        # what the digits so far leave over modulo p, times the inverse of their radix, is the next digit
        known, weight = np.zeros_like(digits[0]), 1
        for d, q in zip(digits, primes, strict=False):
            known = (known + d * weight) % p
            weight = weight * q % p
        digits.append((parts[i].astype(np.int64) - known) % p * pow(weight, -1, p) % p)
    value, radix = np.zeros_like(digits[0], dtype=np.uint64), 1
    for d, p in zip(digits, primes, strict=True):
        value += d.astype(np.uint64) * np.uint64(radix % 2**64)
        radix *= p
    about = np.zeros(value.shape)
    for d, p in zip(digits, primes, strict=True):
        about = (about + d) / p
    value[about > 0.5] -= np.uint64(radix % 2**64)
    return value.view(np.int64)


class Scores:
    """Exact integer products of anchors with the rows of a cell."""

    def __init__(self, rows: np.ndarray, norms: np.ndarray, longest: float):
        self.primes = primes_for(float(norms.max(initial=0)) * longest + 1)
        self.rows = [residues(rows, p) for p in self.primes]

    def of(self, anchors: np.ndarray) -> np.ndarray:
        return signed([modular(residues(anchors, p), r, p) for r, p in zip(self.rows, self.primes, strict=True)], self.primes)


def _cell(cell: pa.Table, asks: pa.Table):
    """The cell by vec_id, and its scores for some anchors at a time."""
    dim = asks["dim"][0].as_py()
    ids = cell["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    asked = matrix(asks["q"], dim)
    scores = Scores(matrix(cell["q"], dim)[order], cell["norm"].to_numpy(), float(asks["norm"].to_numpy().max()))
    blocks = ((at, scores.of(asked[at : at + ROWS])) for at in range(0, len(asked), ROWS))
    return ids[order], cell["row"].to_numpy()[order], cell["label"].to_numpy()[order], blocks


def positives(cell: pa.Table, asks: pa.Table, k: int) -> pa.Table:
    """anchor, positive, vec_id, score: the k best other rows of an anchor's label in a cell."""
    ids, rows, labels, blocks = _cell(cell, asks)
    own, label = asks["row"].to_numpy(), asks["label"].to_numpy()
    out: list[tuple[np.ndarray, ...]] = []
    for at, score in blocks:
        for i in range(len(score)):
            same = np.flatnonzero((labels == label[at + i]) & (rows != own[at + i]))
            # in order of vec_id: a stable sort leaves the smaller first among equal scores
            best = same[np.argsort(-score[i, same], kind="stable")[:k]]
            out.append((np.full(len(best), own[at + i]), rows[best], ids[best], score[i, best]))
    return _table(("anchor", "positive", "vec_id", "score"), out)


def negatives(cell: pa.Table, asks: pa.Table, k: int) -> pa.Table:
    """anchor, positive, vec_id, score: for each positive the k best rows of other labels within its window."""
    ids, _, labels, blocks = _cell(cell, asks)
    label, own = asks["label"].to_numpy(), asks["row"].to_numpy()
    windows, named = asks["windows"].to_pylist(), asks["positives"].to_pylist()
    out: list[tuple[np.ndarray, ...]] = []
    for at, score in blocks:
        for i in range(len(score)):
            low, high = min(w["low"] for w in windows[at + i]), max(w["high"] for w in windows[at + i])
            some = np.flatnonzero((score[i] >= low) & (score[i] <= high) & (labels != label[at + i]))
            some = some[np.argsort(-score[i, some], kind="stable")]
            falling = -score[i, some]
            for w, positive in zip(windows[at + i], named[at + i], strict=True):
                first = int(np.searchsorted(falling, -w["high"]))
                best = some[first : min(first + k, int(np.searchsorted(falling, -w["low"], "right")))]
                out.append((np.full(len(best), own[at + i]), np.full(len(best), positive), ids[best], score[i, best]))
    return _table(("anchor", "positive", "vec_id", "score"), out)


def _table(names: tuple[str, ...], parts: list[tuple[np.ndarray, ...]]) -> pa.Table:
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def mine(vectors: DataFrame, every: int = 50, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, embedding, label. Anchors are the rows whose vec_id ``every`` divides. The positives of one
    are its ``n_positives`` best other rows of the same label. For each of them come the first ``n_negatives`` rows of
    other labels with low * positive_score <= 100 * negative_score <= high * positive_score. The score is the inner
    product of the components floor(scale * x); higher scores first, then smaller vec_ids; fewer rows, if there are no
    more. With a negative positive_score the window is empty. Rows with a NULL vec_id or label, or a vector that is NULL
    or holds a NULL or non-finite component, take no part; rows meet if they have equally many components. A row that
    repeats a vec_id is a row of its own. Other columns are ignored, an empty table gives no rows.
    """
    prefer_skew_handling(vectors.sparkSession)
    labelled = vectors.select("vec_id", "embedding", F.col("label").cast("long").alias("label")).where("label is not null")
    cells = in_cells(whole_numbers(labelled, scale, "label"), "label", "dim")
    anchors = in_blocks(cells.where(F.col("vec_id") % every == 0)).drop("cell")
    kind = "anchor long, positive long, vec_id long, score long"
    held = write_out(cells.select("label", "dim", "cell").distinct(), "label-cells")

    near = meet(cells, anchors.join(held, ["label", "dim"]), lambda c, a: positives(c, a, n_positives), kind)
    by_score = [F.desc("score"), F.col("vec_id"), F.col("positive")]
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(*by_score))
    best = near.withColumn("place", place).where(F.col("place") <= n_positives).drop("place")
    best = write_out(best.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"}), "positives")

    # whole bounds of a window: 100 * score lies between low and high times the positive's score
    bounds = best.select(
        "anchor",
        "positive",
        (-F.floor(-F.col("positive_score").cast("decimal(38,0)") * low / 100)).cast("long").alias("low"),
        F.floor(F.col("positive_score").cast("decimal(38,0)") * high / 100).cast("long").alias("high"),
    ).where("low <= high")
    asked = bounds.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("positive", "low", "high"))).alias("windows"))
    asking = anchors.join(asked, F.col("row") == F.col("anchor")).withColumn("positives", F.col("windows.positive"))
    cells_of = held.select("dim", "cell").distinct()
    far = meet(cells, asking.drop("anchor").join(write_out(cells_of, "dim-cells"), "dim"), lambda c, a: negatives(c, a, n_negatives), kind)

    place = F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "vec_id"))
    chosen = far.withColumn("rank", place).where(F.col("rank") <= n_negatives)
    told = chosen.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(best, ["anchor", "positive"])
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return told.join(named, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding, label of the query's table: where 7 divides vec_id, label is (label + 1) % 10."""
    label = F.col("label").cast("long")
    return vectors.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))


ORACLE = """
WITH rows AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM rows a JOIN rows b ON a.r <> b.r AND len(a.q) = len(b.q)
    WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT a, anchor_id, b, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, b) <= 5
), within AS (
    SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, score AS negative_score,
           row_number() OVER (PARTITION BY p.a, p.b ORDER BY score DESC, s.vec_id)::INTEGER AS rank
    FROM positives p JOIN scored s ON p.a = s.a AND NOT same
        AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM within WHERE rank <= 3
"""
