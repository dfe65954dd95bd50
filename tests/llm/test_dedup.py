"""Exact, near and substring dedup against brute force."""

import hashlib
import random
from collections import defaultdict

import pytest

from bazaarlens.llm import bottom_k, chunk_recipes, recompression
from bazaarlens.llm.components import components
from bazaarlens.llm.queries import QUERIES


def words_of(text):
    return (text or "").encode().split()


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_by_force(rows, width=4):
    sets = {}
    for doc_id, text in rows:
        w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in words_of(text)]
        own = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        sets[doc_id] = own
    lists = defaultdict(list)
    for d, s in sets.items():
        for shingle in s:
            lists[shingle].append(d)
    both = defaultdict(int)
    for own in lists.values():
        for i, a in enumerate(own):
            for b in own[:i]:
                both[b, a] += 1
    root = roots(sets, [(a, b) for (a, b), n in both.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)])
    return sorted((d, len(s), root[d], root[d] == d) for d, s in sets.items())


def repeats_by_force(rows, width=13):
    least = {}
    for d, text in rows:
        w = words_of(text)
        for i in range(len(w) - width + 1 if d is not None else 0):
            key = tuple(w[i : i + width])
            least[key] = min(d, least.get(key, d))
    out = []
    for d, text in rows:
        w = words_of(text)
        gone = [False] * len(w)
        for i in range(len(w) - width + 1 if d is not None else 0):
            if least[tuple(w[i : i + width])] < d:
                gone[i : i + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def documents(duck):
    return duck.sql("SELECT doc_id, text FROM documents").fetchall()


def test_near_query_equals_brute_force(spark, duck, sf_dir):
    made = QUERIES["op3_bottom_k"](spark, sf_dir).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, made)) == near_by_force(documents(duck))


def test_near_copies_of_copies(spark):
    rng = random.Random(1)
    rows = []
    for d in range(250):
        if rows and rng.random() < 0.6:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(1 + len(w) // 30)):
                w[rng.randrange(len(w))] = str(rng.randrange(999))
        else:
            w = [str(rng.randrange(500)) for _ in range(rng.choice([1, 2, 3, 4, 5, 8, 30, 60, 70, 80, 100, 300]))]
        rows.append((d, " ".join(w)))
    made = bottom_k.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted(map(tuple, made)) == near_by_force(rows)


def test_near_hard_rows(texts, no_texts):
    made = bottom_k.near_dedup(texts).collect()
    by_id = {r.doc_id: r for r in made}
    assert len(made) == 15
    assert by_id[2].component_id == 1 and not by_id[2].kept and by_id[1].kept
    assert by_id[4].n_shingles == by_id[5].n_shingles == by_id[6].n_shingles == 0
    assert by_id[4].kept and by_id[5].kept and by_id[6].kept and by_id[None].kept and by_id[None].component_id is None
    assert by_id[11].component_id == 11 and by_id[12].component_id == 11  # one shingle, "a a a a"
    assert bottom_k.near_dedup(no_texts).collect() == []


def test_a_family_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(bottom_k, "BLOCK", 8)  # many blocks on both sides
    rng = random.Random(3)
    base = [str(rng.randrange(10_000)) for _ in range(120)]
    rows = []
    for d in range(90):
        w = list(base)
        for _ in range(rng.randrange(10)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
        rows.append((d, " ".join(w)))
    made = bottom_k.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, made)) == near_by_force(rows)


def test_repeats_query_equals_brute_force(spark, duck, sf_dir):
    made = QUERIES["op2_recompression"](spark, sf_dir).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, made), key=repr) == repeats_by_force(documents(duck))


@pytest.mark.parametrize("kinds", [2, 5, 50])
def test_repeats_of_few_words(spark, kinds):
    rng = random.Random(kinds)
    base = [str(rng.randrange(kinds)) for _ in range(2000)]
    rows = []
    for d in range(60):
        w = []
        while len(w) < rng.randrange(150):
            at = rng.randrange(1900)
            w += base[at : at + rng.randrange(1, 40)] if rng.random() < 0.5 else [str(rng.randrange(kinds)) for _ in range(9)]
        rows.append((d if rng.random() > 0.05 else None, " ".join(w)))
    rows += [(100, "a " * 300), (101, "a " * 30), (102, "b " + "a " * 14)]
    made = recompression.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), digests=True)
    assert sorted(map(tuple, made.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr) == repeats_by_force(rows)


def test_repeats_hard_rows(texts, no_texts):
    made = recompression.remove_repeats(texts, digests=True).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, made), key=repr) == repeats_by_force([(r.doc_id, r.text) for r in texts.collect()])
    carried = recompression.remove_repeats(texts, carry=["keep_id"], layout=True).collect()
    assert {r.carried.keep_id for r in carried} == {7, None}
    assert [r.kept for r in carried if r.doc_id == 1] == ["the cat sat on the mat and then it ran away from the big dog over there"]
    assert recompression.remove_repeats(no_texts).collect() == []


def test_exact_hard_rows(texts, no_texts):
    made = chunk_recipes.dedup(texts).collect()
    assert len(made) == 15
    by_id = {r.doc_id: r for r in made}
    assert by_id[1].keep_id == by_id[2].keep_id == by_id[None].keep_id == 2  # the longest original, white space counts
    assert by_id[1].group_size == 3 and by_id[2].kept and not by_id[1].kept
    assert by_id[4].keep_id == 6 and by_id[4].group_size == 3  # NULL, empty and white space are equal; 6 is the longest
    assert by_id[8].group_size == 2 and all(r.kept for r in made if r.doc_id == 8)
    assert chunk_recipes.dedup(no_texts).collect() == []


def test_clashing_fingerprints_are_spelled_out(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(chunk_recipes.F, "md5", lambda c: F.lit("00"))  # every chunk has the same fingerprint
    rows = [(i, text) for i, text in enumerate(["x y", "xy", "xz", "", None, "xz ", "q" * 9000, "q" * 9000 + "r"])]
    made = chunk_recipes.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in made) == [
        (0, 0, 2), (1, 0, 2), (2, 5, 2), (3, 3, 2), (4, 3, 2), (5, 5, 2), (6, 6, 1), (7, 7, 1),
    ]


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(7, 7), (300, 301), (301, 300)]
    made = components(spark.createDataFrame(links, "a long, b long"), "test").collect()
    root = roots({x for e in links for x in e}, links)
    assert sorted(map(tuple, made)) == sorted((n, r) for n, r in root.items())
    assert components(spark.createDataFrame([], "a long, b long"), "test").collect() == []


def thue_morse(n, a="a", b="b"):
    return [b if i.bit_count() % 2 else a for i in range(n)]


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_and_texts_of_alternating_patterns_stay_apart(spark, n):
    """Patterns whose polynomial fingerprints modulo a power of two are equal: as words, and as words of a text."""
    one, two = "".join(thue_morse(n)), "".join(thue_morse(n, "b", "a"))
    rest = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, " ".join(thue_morse(n))), (4, " ".join(thue_morse(n, "b", "a"))), (5, two)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = recompression.remove_repeats(df, digests=True).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, made)) == repeats_by_force(rows)
    assert sorted(map(tuple, bottom_k.near_dedup(df).collect())) == near_by_force(rows)


def test_numbers_of_words_across_parts(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from bazaarlens.llm import words

    text = pa.array(["ab " + "x" * 700 + " y", "", None, "x" * 700, "y ab  ab", " "])
    whole = words.Words(text).numbers(3)
    monkeypatch.setattr(words, "_PART", 64)
    assert (words.Words(text).numbers(3) == whole).all()
    assert whole[1] == whole[3] and whole[0] == whole[5] == whole[6] and len(np.unique(whole)) == 3


def test_stretches_are_known_by_their_words():
    import numpy as np

    rng = np.random.default_rng(0)
    words_ = rng.integers(0, 3, 400).astype(np.uint64)
    of = recompression.Stretches(words_).of
    low, size = rng.integers(0, 370, 3000), rng.integers(1, 31, 3000)
    names = {}
    for a, n, name in zip(low.tolist(), size.tolist(), of(low, low + size).tolist(), strict=True):
        assert names.setdefault(name, tuple(words_[a : a + n])) == tuple(words_[a : a + n])
    assert len(set(names.values())) == len(names)


def test_smallest_doc_ids_and_extreme_ones(spark):
    rows = [(-(2**63), "a b"), (2**63 - 1, "ab"), (-(2**63), "x"), (5, "x ")]
    made = chunk_recipes.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.keep_id) for r in made) == [(-(2**63), -(2**63)), (-(2**63), 5), (5, 5), (2**63 - 1, -(2**63))]
