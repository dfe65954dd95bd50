"""BPE encoding and decoding with a minimal acyclic transducer for frequent words.

All pre-tokens of the corpus are counted; the most frequent ones are merged once and compiled into a minimal acyclic
automaton. Words with a common ending share its states, and each arc carries the number of words that sort before it,
so the sum along a path is the word's rank and the rank is the place of its ids. The arrays go to executors as one file
that their workers memory-map. A task cuts some megabytes of text at a time into parts without white space and handles
each distinct part once: it walks all distinct words of the new ones through the automaton together; words that are not
in it are merged exactly, also many at once. Decoding turns ids into their tokens.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.shipping import shared_file
from bazaarlens.session import write_out

# fixed value: white space of the pre-tokenizer's pattern (Unicode White_Space)
SPACE = "\t-\r \x85\xa0  -     　"
MEMO = 250_000  # remembered parts of a Python worker; a full memo forgets those that few groups of texts held
SHORT = 16  # ids of a part up to which it stays in a full memo
AGED = 0.9  # what a use counts after each time that parts were forgotten
GROUP = 1 << 22  # bytes of text handled at a time
LONG = 256  # bytes from which on a word is merged by itself, in n log n steps


def _flat(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words one after the other, and the length of each."""
    return np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words], np.int64)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places starts[0], starts[0] + 1, ... of each range, one range after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(counts.sum())


def minimal_automaton(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Arcs (sorted keys state << 8 | byte, targets, outputs) and whether a state is final; state 0 is the start.

    ``words`` are distinct and sorted. States are completed from the end of each word as soon as no later word can
    pass them, and a completed state equal to an earlier one (finality, arcs) is replaced by it. The output of an arc is
    the number of words that leave its state before it does, so outputs along a path add up to the word's rank.
    """
    register: dict[tuple, int] = {}
    arcs_of: list[tuple] = []
    counts: list[int] = []

    def completed(node: list) -> int:
        key = (node[0], tuple(node[1]))
        known = register.get(key)
        if known is None:
            known = register[key] = len(arcs_of)
            arcs_of.append(key)
            counts.append(node[0] + sum(counts[target] for _, target in node[1]))
        return known

    path: list[list] = [[0, []]]  # [final, arcs] for each byte of the last word; the last arc of each is still open
    last = b""
    for word in words:
        same = 0
        while same < min(len(last), len(word)) and last[same] == word[same]:
            same += 1
        while len(path) > same + 1:
            target = completed(path.pop())
            path[-1][1].append((last[len(path) - 1], target))
        path.extend([0, []] for _ in word[same:])
        path[-1][0] = 1
        last = word
    while len(path) > 1:
        target = completed(path.pop())
        path[-1][1].append((last[len(path) - 1], target))
    start = completed(path[0])

    order = [start] + [s for s in range(len(arcs_of)) if s != start]
    number = {s: i for i, s in enumerate(order)}
    keys, targets, outputs = [], [], []
    for s in order:
        before = arcs_of[s][0]
        for byte, target in arcs_of[s][1]:
            keys.append(number[s] << 8 | byte)
            targets.append(number[target])
            outputs.append(before)
            before += counts[target]
    final = np.array([arcs_of[s][0] for s in order], np.int64)
    return np.array(keys, np.int64), np.array(targets, np.int64), np.array(outputs, np.int64), final


class Transducer:
    """Word -> ids over memory-mapped arrays."""

    NAMES = ("keys", "targets", "outputs", "final", "starts", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def compiled(cls, words: dict[bytes, tuple[int, ...]]) -> Transducer:
        ordered = sorted(words)
        arrays = dict(zip(cls.NAMES, minimal_automaton(ordered), strict=False))
        arrays["starts"] = np.cumsum([0] + [len(words[w]) for w in ordered], dtype=np.int64)
        arrays["ids"] = np.array([i for w in ordered for i in words[w]], np.int64)
        return cls(arrays)

    def packed(self) -> bytes:
        """All arrays are 64-bit integers: a header of their lengths, then one after the other."""
        arrays = [np.asarray(getattr(self, n), np.int64) for n in self.NAMES]
        return np.concatenate([np.array([len(a) for a in arrays], np.int64), *arrays]).tobytes()

    @classmethod
    def mapped(cls, path: str) -> Transducer:
        whole = np.memmap(path, np.int64, "r")
        at, arrays = len(cls.NAMES), {}
        for name, n in zip(cls.NAMES, whole[: len(cls.NAMES)].tolist(), strict=True):
            arrays[name] = whole[at : at + n]
            at += n
        return cls(arrays)

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, -1 where it is not in the lexicon."""
        return self.ranks_flat(*_flat(words))

    def ranks_flat(self, flat: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The same for words that lie one after the other; all of them take their next step together."""
        rank, state = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        if not len(self.keys) or not len(length):
            return rank - 1
        begin = np.cumsum(length) - length
        going = np.flatnonzero(length > 0)
        for step in range(int(length.max(initial=0))):
            if not len(going):
                break
            key = state[going] << 8 | flat[begin[going] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            state[going[~found]] = -1
            going, at = going[found], at[found]
            state[going], rank[going] = self.targets[at], rank[going] + self.outputs[at]
            going = going[length[going] > step + 1]
        known = (state >= 0) & (length > 0)
        known[known] = self.final[state[known]] > 0
        return np.where(known, rank, -1)


class WordBpe:
    """A BPE with word ends: normalising, pre-tokens, merges and decoding as its file states them."""

    def __init__(self, tokenizer_json: str):
        import regex

        made = json.loads(tokenizer_json)
        vocab = made["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in made["added_tokens"]}
        self.end = made["model"]["end_of_word_suffix"]
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        pattern = made["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words_of = regex.compile(pattern).findall
        self.ascii_words_of = re.compile(pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"), re.ASCII).findall
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        self.space = re.compile(f"[{SPACE}]+")
        self.odd_space = re.compile("[\x1c-\x1f]").search  # white space to str.split but not to the pattern
        self.odd = "|".join([r"[\x1c-\x1f]", *map(re.escape, self.special)])
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.first = np.array([vocab[self.letter[b]] for b in range(256)], np.int64)
        self.closed = np.array([vocab[self.letter[b] + self.end] for b in range(256)], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in made["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # ranks of two bytes side by side: inside a word, and at its end
        self.byte_ranks = np.stack([self.ranks_of(self.first[:, None], right[None, :]) for right in (self.first, self.closed)])
        self._rank_of: dict[int, int] | None = None

    def pieces(self, text: str) -> list[str]:
        """Parts between white space; no pre-token contains any."""
        return self.space.split(text) if self.odd_space(text) else text.split()

    def parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All parts of texts, and which is the first of each text, and their number. Some may be empty; special strings are parts of their own."""
        if pc.any(pc.match_substring_regex(texts, self.odd)).as_py():
            split = [
                [p for i, part in enumerate(self.cut_special(text)) for p in ([part] if i % 2 else self.pieces(part))]
                for text in texts.to_pylist()
            ]
            return pa.array(chain.from_iterable(split), pa.large_string()), np.cumsum([0, *map(len, split)])
        split = pc.utf8_split_whitespace(texts)
        return split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()

    def words(self, piece: str) -> list[str]:
        """Pre-tokens of a part without white space: composed, each character lowered by itself, cut by the pattern."""
        if piece.isascii():
            piece = piece.lower()
            return [piece] if piece.isalpha() else self.ascii_words_of(piece)
        piece = "".join([c.lower() for c in unicodedata.normalize("NFC", piece)])
        return [piece] if piece.isalpha() else self.words_of(piece)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of ids; the number of merges where there is none."""
        key, never = left << 32 | right, len(self.merged)
        at = np.minimum(np.searchsorted(self.pair_keys, key), never - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], never)

    def merge(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of words by their merges."""
        return _tuples(*self.merge_flat(*_flat(words)))

    def merge_flat(self, flat: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words that lie one after the other: all their ids, where those of each word begin, and how many they are."""
        short = length < LONG
        if short.all():
            return self._merge_rounds(flat, length)
        starts, counts, begin = np.zeros_like(length), np.zeros_like(length), np.cumsum(length) - length
        ids, starts[short], counts[short] = self._merge_rounds(flat[np.repeat(short, length)], length[short])
        made, size = [ids], len(ids)
        for i in np.flatnonzero(~short).tolist():
            made.append(np.array(self._merge_long(flat[begin[i] : begin[i] + length[i]].tobytes()), np.int64))
            starts[i], counts[i] = size, len(made[-1])
            size += len(made[-1])
        return np.concatenate(made), starts, counts

    def _merge_long(self, word: bytes) -> tuple[int, ...]:
        """Ids of one word: a heap of its pairs by rank and place, over a linked list of its symbols."""
        if self._rank_of is None:
            self._rank_of = dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist(), strict=True))
        rank_of, merged = self._rank_of, self.merged.tolist()
        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        ids[-1] = int(self.closed[word[-1]])
        n = len(ids)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(rank, i) for i in range(n - 1) if (rank := rank_of.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            # an entry is out of date if the pair that stands there is another one by now
            if ids[i] < 0 or j < 0 or rank_of.get(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j] = merged[rank], -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (new := rank_of.get(ids[i] << 32 | ids[k])) is not None:
                    heappush(heap, (new, i))
            h = before[i]
            if h >= 0 and (new := rank_of.get(ids[h] << 32 | ids[i])) is not None:
                heappush(heap, (new, h))
        return tuple([i for i in ids if i >= 0])

    def _merge_short(self, words: list[bytes]) -> list[tuple[int, ...]]:
        return _tuples(*self._merge_rounds(*_flat(words)))

    def _merge_rounds(self, flat: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Many words at once: in every round each word merges its first pair of the lowest rank, and only the pairs
        beside it get new ranks."""
        starts, counts, made, size = np.zeros_like(length), np.zeros_like(length), [], 0
        never, word, ends = len(self.merged), np.arange(len(length)), np.cumsum(length)
        ids = self.first[flat]
        ids[ends - 1] = self.closed[flat[ends - 1]]
        rank = np.full(len(flat), never)
        if len(flat) > 1:
            rank[:-1] = self.byte_ranks[0][flat[:-1], flat[1:]]
            last = ends[length > 1] - 1
            rank[last - 1] = self.byte_ranks[1][flat[last - 1], flat[last]]
            rank[ends - 1] = never
        while len(ids):
            # the lowest rank of a word and its first place in one minimum
            least = np.minimum.reduceat(rank << 32 | np.arange(len(ids)), ends - length)
            best, at = least >> 32, least & 0xFFFFFFFF
            ready = best == never
            keep = np.ones(len(ids), bool)
            if ready.any():
                done = np.repeat(ready, length)
                made.append(ids[done])
                own = length[ready]
                counts[word[ready]], starts[word[ready]] = own, size + np.cumsum(own) - own
                size += len(made[-1])
                keep = ~done
                going = ~ready
                best, at, length, word = best[going], at[going], length[going], word[going]
            ids[at] = self.merged[best]
            keep[at + 1] = False
            rank[at] = rank[at + 1]  # none, if that was the end of its word
            at = np.cumsum(keep)[at] - 1
            ids, rank = ids[keep], rank[keep]
            length = length - 1
            ends = np.cumsum(length)
            follows = at[at + 1 < ends]
            rank[follows] = self.ranks_of(ids[follows], ids[follows + 1])
            follows = at[at > ends - length]
            rank[follows - 1] = self.ranks_of(ids[follows - 1], ids[follows])
        return np.concatenate([*made, np.zeros(0, np.int64)]), starts, counts

    def decode(self, ids) -> str:
        """The tokens joined by one space: the file names no decoder. Ids without a token are left out."""
        return " ".join([self.token[i] for i in ids if i in self.token])


def _tuples(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> list[tuple[int, ...]]:
    ids = ids.tolist()
    return [tuple(ids[a : a + n]) for a, n in zip(starts.tolist(), counts.tolist(), strict=True)]


class Encoder:
    """Encodes batches of texts: lexicon for frequent words, merges for the rest, a bounded memo for both.

    Of each of the known ``parts`` of text, ``counts`` ids begin at its place in ``starts``, and ``uses`` is the number
    of groups of texts that held it, earlier ones counting less. Special strings are always known. ``shown`` prepares
    the ids and tokens as text, each with a space after it.
    """

    def __init__(self, bpe: WordBpe, lexicon: Transducer, shown: bool = False):
        self.bpe, self.lexicon = bpe, lexicon
        self.parts = pa.array(list(bpe.special), pa.large_string())
        self.ids = np.array(list(bpe.special.values()), np.int64)
        self.starts, self.counts = np.arange(len(self.ids)), np.ones(len(self.ids), np.int64)
        self.uses = np.full(len(self.ids), np.inf)
        if shown:
            every = range(max(bpe.token) + 1)
            self.id_text = pa.array([b"%d " % i if i in bpe.token else b"" for i in every], pa.large_binary())
            self.token_text = pa.array([bpe.token[i].encode() + b" " if i in bpe.token else b"" for i in every], pa.large_binary())

    def learn(self, new: pa.Array) -> None:
        """Remember parts of text by the ids of their words."""
        made = [self.ids_of_parts(some) for some in _in_groups(new, GROUP // 4)]
        counts = np.concatenate([n for _, n in made])
        starts = len(self.ids) + np.cumsum(counts) - counts
        self.parts = pa.concat_arrays([self.parts, new])
        self.ids = np.concatenate([self.ids, *[ids for ids, _ in made]])
        self.starts, self.counts = np.concatenate([self.starts, starts]), np.concatenate([self.counts, counts])
        self.uses = np.concatenate([self.uses, np.ones(len(new))])

    def ids_of_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts, one part after the other, and how many each has."""
        collecting = gc.isenabled()
        gc.disable()  # many small lists, none in a cycle: the collector would only walk through them
        try:
            words_of = [self.bpe.words(p) for p in parts.to_numpy(zero_copy_only=False).tolist()]
            words = pa.array(chain.from_iterable(words_of), pa.large_string()).dictionary_encode()
            ends = np.cumsum([0, *map(len, words_of)])
            del words_of
        finally:
            if collecting:
                gc.enable()
        ids, starts, counts = self.ids_of(words.dictionary)
        of = words.indices.to_numpy()
        counts = counts[of]
        return ids[_ranges(starts[of], counts)], np.diff(np.cumsum(np.r_[0, counts])[ends])

    def ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct words: ids, where those of each word begin, and how many they are."""
        _, offsets, data = words.buffers()
        at = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
        flat, length = np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]], np.diff(at)
        rank = self.lexicon.ranks_flat(flat, length)
        unseen = rank < 0
        ids, starts, counts = self.lexicon.ids, self.lexicon.starts[rank], self.lexicon.starts[rank + 1]
        counts = counts - starts
        made, starts[unseen], counts[unseen] = self.bpe.merge_flat(flat[np.repeat(unseen, length)], length[unseen])
        starts[unseen] += len(ids)
        return np.concatenate([ids, made]), starts, counts

    def forget(self, held: np.ndarray, room: int) -> None:
        """Keep special strings, the rows ``held`` and short ones used most, in all so many if these are not more."""
        self.uses *= AGED
        uses = np.where(self.counts <= SHORT, self.uses, -1)
        uses[held] = np.inf
        least = len(uses) - max(room, int(np.isinf(uses).sum()))
        kept = np.sort(np.argsort(uses, kind="stable")[max(0, least) :])
        kept = kept[uses[kept] >= 0]
        self.parts = self.parts.take(pa.array(kept))
        self.ids = self.ids[_ranges(self.starts[kept], self.counts[kept])]
        self.counts, self.uses = self.counts[kept], self.uses[kept]
        self.starts = np.cumsum(self.counts) - self.counts

    def rows_of(self, parts: pa.Array) -> np.ndarray:
        """The place of each part among the known ones, -1 for new ones."""
        return pc.index_in(parts, value_set=self.parts).cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).copy()

    def known(self, texts: list[str] | pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
        """For each group of texts: which distinct part each part is, which part is the first of each text and their
        number, the ids of the distinct parts and how many each has."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        for group in _in_groups(texts, GROUP):
            parts, begin = self.bpe.parts(group)
            parts = parts.dictionary_encode()
            rows = self.rows_of(parts.dictionary)
            new = rows < 0
            self.uses[rows[~new]] += 1
            if new.any():
                if len(self.parts) + new.sum() > MEMO or len(self.ids) > SHORT * MEMO:
                    self.forget(rows[~new], MEMO - int(new.sum()))
                    rows = self.rows_of(parts.dictionary)
                rows[new] = np.arange(len(self.parts), len(self.parts) + new.sum())
                self.learn(parts.dictionary.filter(pa.array(new)))
            counts = self.counts[rows]
            yield parts.indices, begin, self.ids[_ranges(self.starts[rows], counts)], counts

    def encode(self, texts: list[str] | pa.Array) -> Iterator[list[tuple]]:
        """For each text (ids,) of its parts, in order."""
        for which, begin, ids, counts in self.known(texts):
            parts = [(i,) for i in _tuples(ids, np.cumsum(counts) - counts, counts)]
            which = which.to_pylist()
            for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
                yield [parts[i] for i in which[a:b]]

    def encode_shown(self, texts: list[str] | pa.Array) -> Iterator[tuple[bytes, bytes]]:
        """For each text its ids as text and its tokens as text, in UTF-8 and joined by one space."""
        for which, begin, ids, counts in self.known(texts):
            both = [_joined(table.take(pa.array(ids)), counts, which, begin) for table in (self.id_text, self.token_text)]
            yield from zip(*both, strict=True)


def _joined(tokens: pa.Array, counts: np.ndarray, which: pa.Array, begin: np.ndarray) -> list[bytes]:
    """The tokens of each text's parts, without the space after the last: parts are runs of ``counts`` tokens."""
    if not len(tokens):
        return [b""] * (len(begin) - 1)
    _, offsets, data = tokens.buffers()
    at = np.frombuffer(offsets, np.int64)[tokens.offset : tokens.offset + len(tokens) + 1][np.cumsum(np.r_[0, counts])]
    parts = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(at), data]).take(which)
    _, offsets, data = parts.buffers()
    at = np.frombuffer(offsets, np.int64)[parts.offset : parts.offset + len(parts) + 1][begin].tolist()
    data = memoryview(data)
    return [bytes(data[a : max(a, b - 1)]) for a, b in zip(at[:-1], at[1:], strict=True)]


def _in_groups(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Consecutive texts of at most so many bytes together, a longer one by itself."""
    total, begin = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
    while begin < len(texts):
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + size, "right")))
        yield texts.slice(begin, end - begin)
        begin = end


def frequent_words(docs: DataFrame, tokenizer_json: str, n: int) -> list[str]:
    """At most n of the most frequent pre-tokens over all texts, without those that occur once.

    A task counts its own words first, so that a word of every document is one row per task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    emptied = 500_000  # distinct parts in memory; more are handed on and counted together later

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, pieces = _bpe(shared.value), defaultdict(int)

        def rows() -> pa.RecordBatch:
            words: dict[str, int] = defaultdict(int)
            for special in bpe.special:
                pieces.pop(special, None)
            for piece, times in pieces.items():
                for word in bpe.words(piece):
                    words[word] += times
            pieces.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for group in _in_groups(_texts(batch), 4 * GROUP):
                values, times = bpe.parts(group)[0].value_counts().flatten()
                for piece, n in zip(values.to_numpy(zero_copy_only=False).tolist(), times.to_numpy().tolist(), strict=True):
                    pieces[piece] += n
                if len(pieces) > emptied:
                    yield rows()
        yield rows()

    words = docs.select("text").mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = write_out(words.where("n > 1"), "word-counts")
    # a few hundred classes of counts say from which count on n words at most are left
    kind = F.floor(F.log2("n") * 16)
    sizes = words.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("kind")).collect()
    least, taken = None, 0
    for row in sizes:
        taken += row["words"]
        if taken > n:
            break
        least = row["kind"]
    if least is None:
        return []
    return [r["word"] for r in words.where(kind >= least).select("word").collect()]


def _texts(batch: pa.RecordBatch) -> pa.Array:
    return batch["text"].cast(pa.large_string()).fill_null("")


_bpes: dict[str, WordBpe] = {}
_encoders: dict[tuple[str, bool], Encoder] = {}


def _bpe(tokenizer_json: str) -> WordBpe:
    key = hashlib.md5(tokenizer_json.encode()).hexdigest()
    return _bpes.get(key) or _bpes.setdefault(key, WordBpe(tokenizer_json))


def lexicon_file(docs: DataFrame, tokenizer_json: str, n: int) -> str:
    """The compiled lexicon of the n most frequent words, handed to executors; the name under which they find it."""
    bpe = WordBpe(tokenizer_json)
    words = [w.encode() for w in frequent_words(docs, tokenizer_json, n)]
    lexicon = Transducer.compiled(dict(zip(words, bpe.merge(words), strict=True)))
    name = f"lexicon-{uuid4().hex}"
    docs.sparkSession.sparkContext.addFile(shared_file(docs.sparkSession, name, lexicon.packed()))
    return name


def encode(docs: DataFrame, tokenizer_json: str, lexicon: str, digests: bool = False) -> DataFrame:
    """One row per document: doc_id, ids; or with ``digests`` doc_id, n_tokens, ids_sha256, decoded_sha256.

    NULL and empty texts have no ids. Rows with a NULL or repeated doc_id are encoded like any other, other columns are
    ignored, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # one vocabulary file, about 2 MB

    def encoder() -> Encoder:
        if (lexicon, digests) not in _encoders:
            _encoders.clear()
            _encoders[lexicon, digests] = Encoder(_bpe(shared.value), Transducer.mapped(SparkFiles.get(lexicon)), digests)
        return _encoders[lexicon, digests]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [[i for part in parts for i in part[0]] for parts in encoder().encode(_texts(batch))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, str, str]] = []
            for ids, decoded in encoder().encode_shown(_texts(batch)):
                n = ids.count(b" ") + 1 if ids else 0
                rows.append((n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            columns = zip(*rows, strict=True) if rows else ([], [], [])
            kinds = (pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    docs = docs.select(F.col("doc_id").cast("long"), "text")
    if digests:
        return docs.mapInArrow(digested, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return docs.mapInArrow(listed, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer_json: str) -> DataFrame:
    """doc_id, text: what the ids stand for, in the file's own spelling. NULL ids count as none."""
    shared = encoded.sparkSession.sparkContext.broadcast(tokenizer_json)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(shared.value)
        for batch in batches:
            out = [bpe.decode(ids or ()) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(texts, "doc_id long, text string")
