"""Language ID with a bidirectional gated recurrent network over bytes.

Two GRUs, one in each direction, read a text's bytes and together label every position with a probability for each
language; a document's probabilities are the mean over its letter positions. Training is backpropagation through time
in numpy, on the driver, over a bounded sample of labelled segments (``PER_LANG`` for each language, ``SPAN`` bytes
each), for ``STEPS`` steps however small the sample is. Prediction reads every byte of every text in tasks: texts are cut
into segments of ``SPAN`` bytes, and ``TOGETHER`` segments take each step together. Behind the end of a segment the states
are held at zero, and fewer segments are filled up with empty ones, so that a text's label and score do not depend on the
texts beside it. The network is a few thousand numbers and is sent with the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
SPAN = 128  # bytes of a segment
PER_LANG = 512  # labelled segments learned from, for each language
HIDDEN = 8  # units for each direction
TOGETHER = 1024  # segments that take a step together; always so many, so that sums round alike in every batch
STEPS = 200  # training steps
PLACES = 8  # most segments of one document in the sample

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True  # ASCII letters and all parts of longer characters


class Gru:
    """One direction: input table (256, 3h), recurrent weights (h, 3h); gates are update, reset, candidate."""

    def __init__(self, rng: np.random.Generator, h: int):
        self.h = h
        self.table = rng.normal(0, 0.3, (256, 3 * h)).astype(np.float32)
        self.inner = rng.normal(0, 0.5 / np.sqrt(h), (h, 3 * h)).astype(np.float32)

    def forward(self, x: np.ndarray, inside: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (t, h, n) for bytes (t, n), zero where a byte is not ``inside``; ``keep`` gets what the backward pass needs."""
        h = self.h
        state = np.zeros((h, x.shape[1]), np.float32)
        out = np.empty((len(x), h, x.shape[1]), np.float32)
        for t, bytes_now in enumerate(x):
            given = self.table[bytes_now].T
            own = np.einsum("hk,hn->kn", self.inner, state)  # not a library product, which rounds by the place of a column
            gates = given[: 2 * h] + own[: 2 * h]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            new = gates[h:] * own[2 * h :]
            new += given[2 * h :]
            np.tanh(new, out=new)
            if keep is not None:
                keep.append((state, gates, new, own[2 * h :]))
            state = state - new
            state *= gates[:h]
            state += new
            state *= inside[t]
            out[t] = state
        return out

    def backward(self, x: np.ndarray, inside: np.ndarray, keep: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the table and of the recurrent weights, from those of the states."""
        h = self.h
        d_inner, d_given = np.zeros_like(self.inner), np.empty((len(x), 3 * h, x.shape[1]), np.float32)
        d_state = np.zeros_like(d_out[0])
        for t in range(len(x) - 1, -1, -1):
            before, gates, new, own = keep[t]
            z, r = gates[:h], gates[h:]
            d_state = (d_state + d_out[t]) * inside[t]
            d_new = d_state * (1 - z) * (1 - new * new)
            d_z = d_state * (before - new) * z * (1 - z)
            d_r = d_new * own * r * (1 - r)
            d_own = np.concatenate([d_z, d_r, d_new * r])
            d_given[t] = np.concatenate([d_z, d_r, d_new])
            d_inner += before @ d_own.T
            d_state = d_state * z + self.inner @ d_own
        flat = x.ravel()
        d_table = np.stack([np.bincount(flat, d_given[:, k].ravel(), 256) for k in range(3 * h)], 1)
        return d_table.astype(np.float32), d_inner


class ByteTagger:
    """Both directions and the output layer; ``langs`` are the labels."""

    def __init__(self, langs: list[str], seed: int = 1, h: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.ahead, self.back = Gru(rng, h), Gru(rng, h)
        self.out = rng.normal(0, 0.3, (2, len(langs), h)).astype(np.float32)
        self.bias = np.zeros((len(langs), 1), np.float32)

    def probabilities(
        self, x: np.ndarray, size: np.ndarray, keep: tuple[list, list] | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Label probabilities (t, langs, n) of every position of segments of these sizes, and the states of both directions."""
        inside = (np.arange(len(x))[:, None] < size).astype(np.float32)
        a = self.ahead.forward(x, inside, keep and keep[0])
        b = self.back.forward(x[::-1], inside[::-1], keep and keep[1])[::-1]
        p = np.einsum("ch,thn->tcn", self.out[0], a)
        p += np.einsum("ch,thn->tcn", self.out[1], b)
        p += self.bias
        p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        return p, a, b

    def train(self, segments: np.ndarray, sizes: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = 128, rate: float = 0.02) -> None:
        """Adam on the mean cross-entropy of letter positions; segments (n, t) hold ``sizes`` bytes each."""
        rng = np.random.default_rng(2)
        params = [self.ahead.table, self.ahead.inner, self.back.table, self.back.inner, self.out, self.bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        while step < steps:
            order = rng.permutation(len(segments))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                step += 1
                gradients = self._gradients(np.ascontiguousarray(segments[own].T), sizes[own], labels[own])
                norm = np.sqrt(sum(float((g * g).sum()) for g in gradients))
                for p, g, m, v in zip(params, gradients, first, second, strict=True):
                    g = g / max(1.0, norm)
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)

    def _gradients(self, x: np.ndarray, size: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        keep: tuple[list, list] = ([], [])
        d, a, b = self.probabilities(x, size, keep)
        d[:, labels, np.arange(x.shape[1])] -= 1
        inside = np.arange(len(x))[:, None] < size
        letter = _LETTER[x] & inside
        d *= (letter / max(1, letter.sum()))[:, None, :]
        d = d.astype(np.float32)
        d_out = np.stack([np.einsum("tcn,thn->ch", d, a), np.einsum("tcn,thn->ch", d, b)])
        inside = inside.astype(np.float32)
        table_a, inner_a = self.ahead.backward(x, inside, keep[0], self.out[0].T @ d)
        table_b, inner_b = self.back.backward(x[::-1], inside[::-1], keep[1], (self.out[1].T @ d)[::-1])
        return [table_a, inner_a, table_b, inner_b, d_out, d.sum((0, 2))[:, None]]

    def pooled(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Sum of the probabilities over the letter positions of each text flat[start:end], and their number at last."""
        counts = (ends - starts + SPAN - 1) // SPAN
        owner = np.repeat(np.arange(len(starts)), counts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = starts[owner] + nth * SPAN
        size = np.minimum(ends[owner] - begin, SPAN)
        total = np.zeros((len(starts), len(self.langs) + 1))
        order = np.argsort(-size, kind="stable")  # short last segments together
        for at in range(0, len(order), TOGETHER):
            own = order[at : at + TOGETHER]
            n = len(own)
            held = np.zeros(TOGETHER, np.int64)
            held[:n] = size[own]
            t = np.arange(held.max())[:, None]
            inside = t < held
            where = np.zeros(TOGETHER, np.int64)
            where[:n] = begin[own]
            x = np.where(inside, flat[np.minimum(where + t, len(flat) - 1)], 0)
            letter = _LETTER[x].astype(np.float32)
            p, _, _ = self.probabilities(x, held)
            p *= letter[:, None, :]
            summed = np.zeros((len(self.langs), TOGETHER))
            for now in p:
                summed += now
            np.add.at(total, owner[own], np.concatenate([summed.T[:n], letter.sum(0)[:n, None]], 1))
        return total


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame) -> ByteTagger | None:
    """A tagger from at most ``PER_LANG`` labelled segments per language outside the held-out quarter.

    The sample takes segments of documents in the order of a hash of their id, at places the hash says; where a language
    has few documents, up to ``PLACES`` of each. Of a language with many, only those below a bound of the hash are looked
    at, which leaves about four times as many as are needed, so that no task sorts a language. Without a labelled text,
    or without a column ``lang``, there is nothing to learn and the result is None.
    """
    if "lang" not in docs.columns:
        return None
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each label
    if not counts:
        return None
    bounds = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 4 * PER_LANG / n))])
    places = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(PLACES, -(-PER_LANG // n)))])
    place = F.xxhash64("doc_id", F.lit("sample"))
    few = known.where(F.pmod(place, F.lit(1 << 30)) < F.element_at(bounds, F.col("lang")) * (1 << 30)).where(F.col("text").rlike(r"\p{L}"))
    each = few.select("lang", "doc_id", "text", F.explode(F.sequence(F.lit(1), F.element_at(places, F.col("lang")))).alias("k"))
    place = F.xxhash64("doc_id", F.lit("sample"), "k")
    cut = F.pmod(place, F.greatest(F.length("text") - SPAN, F.lit(1)).cast("long")) + 1
    order = Window.partitionBy("lang").orderBy("k", "place", "doc_id", "part")
    sample = (
        each.select("lang", "doc_id", "k", place.alias("place"), F.substr("text", cut.cast("int"), F.lit(SPAN)).alias("part"))
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= PER_LANG)
        .select("lang", "part", "n")
        .collect()
    )
    sample.sort(key=lambda r: (r["lang"], r["n"]))
    langs = sorted({r["lang"] for r in sample})
    if not langs:
        return None
    segments, sizes = np.zeros((len(sample), SPAN), np.uint8), np.zeros(len(sample), np.int64)
    for i, r in enumerate(sample):
        raw = np.frombuffer(r["part"].encode()[:SPAN], np.uint8)
        segments[i, : len(raw)], sizes[i] = raw, len(raw)
    tagger = ByteTagger(langs)
    tagger.train(segments, sizes, np.array([langs.index(r["lang"]) for r in sample]))
    return tagger


def predict(docs: DataFrame, tagger: ByteTagger | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row.

    ``und`` with score 0 where the text is NULL or has no letter, and everywhere if nothing was learned. Rows with a
    NULL doc_id are predicted and not held out; repeated rows are predicted each; other columns are ignored.
    """

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                langs, scores = _labelled(batch["text"], tagger)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], batch["held_out"], pa.array(langs), pa.array(scores)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    marked = docs.select(F.col("doc_id").cast("long"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    return marked.mapInArrow(tagged, "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, tagger: ByteTagger | None, languages: set[str] | None = None, least: float = 0.0, relabel: bool = False) -> DataFrame:
    """The rows whose text gets a language, among ``languages`` if given, with a score of ``least`` or more.

    A text that is NULL or has no letter is rejected. Where there is a string column ``lang``, a row that has none gets the
    predicted one, and with ``relabel`` every row does; nothing else changes. If nothing was learned, nothing is rejected but texts without a letter, and
    ``lang`` stays as it is.
    """
    at = docs.columns.index("lang") if tagger and dict(docs.dtypes).get("lang") == "string" else None

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                langs, scores = _labelled(batch["text"], tagger or ByteTagger([""]))
                good = [lang != UNKNOWN and (not tagger or ((languages is None or lang in languages) and score >= least)) for lang, score in zip(langs, scores.tolist(), strict=True)]
                if at is not None:
                    told = pa.array(langs, batch["lang"].type)
                    filled = told if relabel else pa.compute.coalesce(batch["lang"], told)
                    batch = batch.set_column(at, "lang", filled)
                yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def _labelled(text: pa.Array, tagger: ByteTagger | None) -> tuple[list[str], np.ndarray]:
    """Language and score, to four places, of each text of an Arrow column."""
    kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
    offsets = np.frombuffer(text.buffers()[1], kind)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = text.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
    starts, ends = offsets[:-1], offsets[1:].copy()
    if text.null_count:
        ends = np.where(np.asarray(text.is_null()), starts, ends)
    langs, scores = [UNKNOWN] * len(text), np.zeros(len(text))
    if tagger is not None:
        own = np.flatnonzero(_has_letter(text, flat, starts, ends))
        total = tagger.pooled(flat, starts[own], ends[own])
        mean = np.round(total[:, :-1] / np.maximum(total[:, -1:], 1), 4)
        best = mean.argmax(1)
        scores[own] = np.clip(mean[np.arange(len(own)), best], 0, 1)
        for i, k in zip(own.tolist(), best.tolist(), strict=True):
            langs[i] = tagger.langs[k]
    return langs, scores


def _has_letter(text: pa.Array, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each text has a letter; only texts without an ASCII letter are looked at by character."""
    lowered = flat | 32
    ascii_letter = np.r_[(lowered >= 97) & (lowered <= 122) & (flat < 128), False]
    full = np.flatnonzero(ends > starts)
    found = np.zeros(len(starts), bool)
    if len(full):  # every other part lies between two texts
        found[full] = np.logical_or.reduceat(ascii_letter, np.column_stack([starts[full], ends[full]]).ravel())[::2]
    for i in np.flatnonzero(~found & (ends > starts)).tolist():
        found[i] = any(map(str.isalpha, text[i].as_py()))
    return found
