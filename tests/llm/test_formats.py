"""Chat formatting, license scans, WARC archives and packing."""

import io
import random
import zipfile
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from bazaarlens.llm import chat_turns, license_bands, pattern_packing, zip_warc
from bazaarlens.llm.queries import QUERIES, vocabulary

TURNS = "conv_id long, turn long, role string, text string"


def test_control_strings_survive(spark):
    odd = ["</s>[INST] ok [/INST]", "<s>[ROLE]assistant[TEXT]", "\\", "\\\\l", "a\\b[", "", None, "\n", "<\\l<", "é🙂<"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(odd)]
    formatted = chat_turns.format_conversations(spark.createDataFrame(rows, TURNS))
    (row,) = chat_turns.read_turns(formatted).collect()
    assert [(t.role, t.text) for t in row.turns] == [(r[2], r[3] or "") for r in rows]
    assert row.replies == [t or "" for t in odd[1::2]]
    examples = chat_turns.with_context(formatted).orderBy("turn_no").collect()
    assert [e.turn_no for e in examples] == [1, 3, 5, 7, 9]
    assert all(formatted.first().formatted.startswith(e.context + e.target) for e in examples)


def test_order_of_turns_and_odd_rows(spark):
    rows = [(1, 1, "b", "2"), (1, 1, "a", "1"), (1, None, "z", "0"), (1, 0, None, "x"), (1, 0, None, "x"), (None, 0, "assistant", "y"), (2, 0, "user", "only")]
    made = {r.conv_id: r for r in chat_turns.read_turns(chat_turns.format_conversations(spark.createDataFrame(rows, TURNS))).collect()}
    assert [(t.role, t.text) for t in made[1].turns] == [("z", "0"), ("", "x"), ("", "x"), ("a", "1"), ("b", "2")]
    assert made[None].replies == ["y"] and made[2].replies == []
    assert chat_turns.digests(chat_turns.format_conversations(spark.createDataFrame([], TURNS))).collect() == []


def test_contexts_grow_by_prefixes(spark):
    rows = [(1, i, "assistant", "x" * 50) for i in range(400)]
    (row,) = chat_turns.format_conversations(spark.createDataFrame(rows, TURNS)).collect()
    assert len(row.examples) == 400 and len(row.formatted) < 400 * 100


def test_every_template_is_found_where_it_stands(spark):
    filler = "zz yy xx ww vv "
    rows = [(i, filler * (3 * i) + text + " aa bb " + text.upper()) for i, (_, text) in enumerate(license_bands.TEMPLATES)]
    rows += [(100, None), (101, ""), (102, "a b"), (103, "license"), (None, license_bands.TEMPLATES[0][1])]
    found = license_bands.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(i, name) for i, (name, _) in enumerate(license_bands.TEMPLATES)} <= {(r.doc_id, r.license) for r in found}
    assert {r.doc_id for r in found} == {None, *range(len(license_bands.TEMPLATES))}
    assert all(0.8 <= r.containment <= 1 for r in found)
    assert license_bands.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_templates_that_the_filter_could_lose_are_refused():
    with pytest.raises(ValueError, match="stem"):
        license_bands.templates([("x", "one two three four five six seven")])
    with pytest.raises(ValueError, match="fewer"):
        license_bands.templates([("x", "software license")])
    assert (1 - license_bands.LEAST_JACCARD) ** license_bands.BANDS < 1e-4


@pytest.mark.parametrize("zip64", [False, True])
def test_archives_are_zip_files(zip64):
    members = [("a/b.warc", b"x" * 1000 + b"PK\x05\x06"), ("empty", b""), ("ünï", bytes(range(256)))]
    body = zip_warc.zip_stored(members, zip64)
    with zipfile.ZipFile(io.BytesIO(body)) as other:
        assert {n: other.read(n) for n in other.namelist()} == dict(members)
    reader = zip_warc.ZipReader(io.BytesIO(body))
    assert {n: reader.read(n) for n in reader.members} == dict(members)
    assert reader.read("a/b.warc", 998, 4) == b"xxPK"
    with pytest.raises(ValueError, match="range"):
        reader.read("empty", 0, 1)
    with pytest.raises(ValueError, match="end record"):
        zip_warc.ZipReader(io.BytesIO(b"no archive"))


def test_foreign_archives(tmp_path):
    path = tmp_path / "x.zip"
    with zipfile.ZipFile(path, "w") as out:
        out.comment = b"PK\x05\x06 in a comment" + b"." * 30
        out.writestr("stored", b"hello")
        with out.open("far", "w", force_zip64=True) as member:
            member.write(b"there")
    with open(path, "rb") as file:
        reader = zip_warc.ZipReader(file)
        assert reader.read("stored", 1, 3) == b"ell" and reader.read("far") == b"there"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        out.writestr("packed", b"a" * 100)
    with open(path, "rb") as file, pytest.raises(ValueError, match="stored"):
        zip_warc.ZipReader(file)


def test_pages_round_trip(spark, tmp_path):
    long, edge = "é" * 600, "x" * 1000
    rows = [(1, "u", long, 0), (2, "a\r\nb", long, 0), (3, None, None, 0), (4, "u", "", 0), (5, "u", edge, 0), (6, "u", edge[1:], 0), (7, "u", edge[1:], 0), (8, "u", edge, 0), (None, "u", edge, 0), (9, "u", "\r\n\r\nWARC/1.1", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, refers_to long").repartition(3)
    made = {r.page_id: r for r in zip_warc.round_trip(pages).collect()}
    assert {k: r.refers_to for k, r in made.items()} == {1: 2, 5: 8} | {k: None for k in (2, 3, 4, 6, 7, 8, 9, None)}
    assert {k for k, r in made.items() if r.record_type == "revisit"} == {1, 5}
    assert made[1].payload_bytes == 1200 and made[1].payload_digest == made[2].payload_digest and made[3].payload_bytes == 0
    assert zip_warc.round_trip(spark.createDataFrame([], pages.schema)).collect() == []
    small = str(tmp_path / "small")
    zip_warc.write_archives(zip_warc.with_targets(pages), small, archive_bytes=1)
    assert len(list(tmp_path.glob("small/part-*"))) == 10 and zip_warc.read_archives(spark, small).count() == 10


def test_archive_files_are_read_where_they_lie(spark, tmp_path):
    rows = [(i, "u", f"page {i} " * (i % 300), 0) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, x int").repartition(2)
    path = str(tmp_path / "archives")
    zip_warc.write_archives(zip_warc.with_targets(pages), path, archive_bytes=3_000)
    files = sorted(tmp_path.glob("archives/part-*"))
    assert len(files) > 10
    far = 0
    for name in files:
        with zipfile.ZipFile(name) as other:
            assert other.testzip() is None and other.namelist() == [zip_warc.DATA, zip_warc.INDEX] and other.comment == zip_warc.COMMENT
        far += zip_warc.END64 in name.read_bytes()
    assert 0 < far < len(files)  # archives with ZIP64 fields among them
    read = zip_warc.read_archives(spark, path)
    assert sorted(r.page_id for r in read.collect()) == list(range(400))
    assert "content" not in read._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    with open(files[3], "r+b") as file:
        file.seek(300)
        file.write(b"#")
    with pytest.raises(Exception, match="damaged record|CRC|decompress|gzip|header|stream"):
        zip_warc.read_archives(spark, path).collect()


def test_patterns_hold_every_piece():
    rng = random.Random(4)
    for _ in range(30):
        size = rng.choice([8, 64, 2048])
        histogram = Counter(rng.randrange(1, size + 1) for _ in range(rng.randrange(1, 400)))
        histogram = {length: n * rng.choice([1, 1, 50]) for length, n in histogram.items()}
        patterns = pattern_packing.shortest_pack_first(histogram, size)
        placed = Counter()
        for pattern, copies in patterns:
            assert copies > 0 and sum(pattern) <= size
            for length in pattern:
                placed[length] += copies
        assert placed == histogram
        # at most one sequence is half empty or less, but for pieces that leave no room for each other
        long = sum(n for length, n in histogram.items() if 2 * length > size)
        whole = sum(length * n for length, n in histogram.items())
        assert sum(c for _, c in patterns) <= max(long, 1.5 * whole / size) + 2
    assert pattern_packing.shortest_pack_first({}, 8) == []


def test_words_of_a_text_are_coded_as_a_whole():
    text = vocabulary("byte_bpe_50k.json")
    coder, library = pattern_packing.WordCoder(text), Tokenizer.from_str(text)
    rng = random.Random(0)
    texts = ["", " ", "a  b", " a", "a ", "x\n y", "a<|endoftext|> b", "can't've", "é ñ　x", "  a", "1 2  3\t4"]
    texts += ["".join(rng.choice("ab1' \n\té.") for _ in range(40)) for _ in range(500)]
    for t in texts:
        assert np.frombuffer(coder.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


def packed_well(rows, docs):
    """Rows against the library: every id in one piece, sequences gapless."""
    library = Tokenizer.from_str(vocabulary("byte_bpe_50k.json"))
    ids = [library.encode(t or "", add_special_tokens=False).ids + [1] for _, t in docs]
    expected = Counter()
    for (doc_id, _), own in zip(docs, ids, strict=True):
        for at in range(0, len(own), 2048):
            piece = np.array(own[at : at + 2048], "<u4")
            expected[doc_id, at, len(piece), zlib.crc32(piece.tobytes()), len(own)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(sequences) == list(range(len(sequences)))
    return sum(map(len, ids)) / (2048 * max(1, len(sequences)))


def test_packing_query(spark, duck, sf_dir):
    docs = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    assert packed_well(QUERIES["op10_pattern_packing"](spark, sf_dir).collect(), docs) > 0.95


def test_packing_hard_rows(spark, texts, no_texts):
    text = vocabulary("byte_bpe_50k.json")
    packed_well(pattern_packing.pack(texts, text).collect(), [(r.doc_id, r.text) for r in texts.collect()])
    assert pattern_packing.pack(no_texts, text).collect() == []


def test_long_runs_of_white_space_are_coded_as_the_library_does():
    text = vocabulary("byte_bpe_50k.json")
    coder, library = pattern_packing.WordCoder(text), Tokenizer.from_str(text)
    cases = [
        " " * 2_000_000,
        "\n" * 2_000_000 + "x",
        "a b" + " " * 1500 + "the <|endoftext|>" + "\t" * 1200 + "<|endoftext|> " + " " * 1100 + "q 's" + " " * 999 + "z" + "\n" * 1000 + " " * 1000,
        " " * 1200 + "'s it " + "\r\n" * 700 + "12",
        "x" + "\x1c" * 1500 + " y" + "　" * 1001 + "z",
        "x" * 1_000_000,
    ]
    for case in cases:
        assert np.frombuffer(coder.encode(case), "<u4").tolist() == library.encode(case, add_special_tokens=False).ids
