import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from bazaarlens.llm import word_transducer as W
from bazaarlens.llm.queries import QUERIES, vocabulary


@pytest.fixture(scope="module")
def made():
    text = vocabulary("word_bpe_49k.json")
    return W.WordBpe(text), Tokenizer.from_str(text)


ODD = ["", " ", "a<|endoftext|> B's", "<|startoftext|>", "ſ İ ǅ ½ ٣ 中文 ΑΣ Σ", "can't've I'M", "x\x1c y\x1fz", "é a ́b Å", "x" * 300,
       "\x00\x85 a​b ﻿ <|endof", "🙂👨‍👩‍👧 ½²", "ﬁ ǰ̣ K Ω", "a b c d"]


def test_automaton_gives_ranks_and_shares_endings():
    words = sorted(a + b for a in (b"walk", b"talk", b"jump") for b in (b"", b"s", b"ed", b"ing"))
    lexicon = W.Transducer.compiled({w: (i,) for i, w in enumerate(words)})
    assert lexicon.ranks(words).tolist() == list(range(len(words)))
    assert (lexicon.ranks([b"", b"wal", b"walke", b"walkss", b"x"]) == -1).all()
    assert len(lexicon.final) < 16  # 12 words of up to 7 letters
    assert (W.Transducer.compiled({}).ranks([b"a", b""]) == -1).all()


def test_memory_mapped_lexicon_is_the_compiled_one(tmp_path):
    words = {b"a": (1,), b"ab": (2, 3), b"b": (4, 5, 6)}
    (tmp_path / "lexicon").write_bytes(W.Transducer.compiled(words).packed())
    mapped = W.Transducer.mapped(str(tmp_path / "lexicon"))
    ranks = mapped.ranks(sorted(words)).tolist()
    assert [tuple(mapped.ids[mapped.starts[r] : mapped.starts[r + 1]].tolist()) for r in ranks] == [words[w] for w in sorted(words)]


def test_unseen_words_merge_exactly(made):
    bpe, library = made
    own = W.Encoder(bpe, W.Transducer.compiled({}))
    rng = np.random.default_rng(0)
    texts = ODD + ["".join(rng.choice(list("etaoin shrdluÉßΣ'.,-19\n"), 60)) for _ in range(300)]
    for text, parts in zip(texts, own.encode(texts), strict=True):
        assert [i for p in parts for i in p[0]] == library.encode(text, add_special_tokens=False).ids, text


def test_query_equals_the_library(spark, duck, sf_dir, made):
    _, library = made
    rows = {r.doc_id: r for r in QUERIES["op1_word_transducer"](spark, sf_dir).collect()}
    docs = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    assert len(rows) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        said = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        back = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert (rows[doc_id].n_tokens, rows[doc_id].ids_sha256, rows[doc_id].decoded_sha256) == (len(ids), said, back)


def test_hard_rows(spark, texts, no_texts, made):
    text = vocabulary("word_bpe_49k.json")
    _, library = made
    lexicon = W.lexicon_file(texts, text, 10)
    encoded = W.encode(texts, text, lexicon)
    expected = sorted((r.doc_id or -1, library.encode(r.text or "", add_special_tokens=False).ids) for r in texts.collect())
    assert sorted((r.doc_id or -1, r.ids) for r in encoded.collect()) == expected
    decoded = sorted((r.doc_id or -1, r.text) for r in W.decode(encoded, text).collect())
    assert decoded == sorted((d, library.decode(i, skip_special_tokens=False)) for d, i in expected)
    assert W.encode(no_texts, text, W.lexicon_file(no_texts, text, 10)).collect() == []


def test_long_words_merge_as_short_ones_and_as_the_library(made):
    bpe, library = made
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("etaoinshrdlu"), n)).encode() for n in (1, 2, 255, 256, 257, 900, 3000)]
    words += [b"a" * 700, "éß中".encode() * 100, b"ing" * 300]
    assert [bpe._merge_long(w) for w in words] == bpe._merge_short(words)
    assert bpe.merge(words) == bpe._merge_short(words)
    text = "".join(rng.choice(list("etaoinshrdlu"), 1_000_000))
    (ids,) = bpe.merge([text.encode()])
    assert list(ids) == library.encode(text, add_special_tokens=False).ids
    assert W.Transducer.compiled({b"ab": (1,)}).ranks([text.encode(), b"ab"]).tolist() == [-1, 0]


def test_the_collector_rests_while_parts_are_learnt():
    import gc

    import public_tokenizers

    from bazaarlens.llm import word_transducer

    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        bpe = word_transducer.WordBpe(file.read())
    words, seen = bpe.words, []
    bpe.words = lambda piece: (seen.append(gc.isenabled()), words(piece))[1]
    encoder = word_transducer.Encoder(bpe, word_transducer.Transducer.compiled({}), shown=True)
    ((ids, decoded),) = encoder.encode_shown(["Two parts"])
    assert seen == [False, False] and gc.isenabled()
    assert [bpe.token[int(i)].encode() for i in ids.split()] == decoded.split(b" ")


def test_parts_end_at_the_pattern_s_white_space(made):
    import re

    import pyarrow as pa

    bpe, _ = made
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    odd = [c for c in every if bpe.odd_space(c)]
    for signs in (odd, [c for c in every if c not in odd]):
        parts, begin = bpe.parts(pa.array([f"a{c}b" for c in signs], pa.large_string()))
        cut = [c for c, n in zip(signs, np.diff(begin).tolist(), strict=True) if n == 2]
        assert cut == [c for c in signs if re.match(f"[{W.SPACE}]", c)]
        assert len(parts) == len(signs) + len(cut)


def test_a_full_memo_and_small_groups_change_no_result(made, monkeypatch):
    bpe, library = made
    monkeypatch.setattr(W, "MEMO", 20)
    monkeypatch.setattr(W, "GROUP", 40, raising=False)
    rng = np.random.default_rng(2)
    words = ["the", "The,", "cat", "don't", "ñandú", "ΑΣ", "x" * 300, "<|endoftext|>", "12", "\x1c", "中文"]
    texts = ODD + ["".join(w + s for w, s in zip(rng.choice(words, 12), rng.choice([" ", "", "\n ", "\u3000"], 12), strict=True)) for _ in range(200)]
    texts += [" ".join("".join(rng.choice(list("etaoin"), 6)) for _ in range(30)) for _ in range(20)]
    frequent = [b"the", b"cat", b"dont"]
    lexicon = W.Transducer.compiled(dict(zip(frequent, bpe.merge(frequent), strict=True)))
    own, shown = W.Encoder(bpe, lexicon), W.Encoder(bpe, lexicon, shown=True)
    both = zip(texts, own.encode(texts), shown.encode_shown(texts), strict=True)
    for text, parts, (ids, decoded) in both:
        expected = library.encode(text, add_special_tokens=False).ids
        assert [i for p in parts for i in p[0]] == expected, text
        assert (ids, decoded) == (" ".join(map(str, expected)).encode(), library.decode(expected, skip_special_tokens=False).encode()), text


def test_a_full_memo_keeps_frequent_parts(made, monkeypatch):
    bpe, _ = made
    monkeypatch.setattr(W, "MEMO", 20)
    words, cut = bpe.words, []
    monkeypatch.setattr(bpe, "words", lambda piece: (cut.append(piece), words(piece))[1])
    encoder = W.Encoder(bpe, W.Transducer.compiled({}), shown=True)
    for i in range(50):  # every other group is without it
        list(encoder.encode_shown([" ".join(["of"] * (i % 2 == 0) + [f"a{i}b{j}" for j in range(5)])]))
    assert cut.count("of") == 1 and len(cut) == 251
