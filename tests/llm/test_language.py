import zlib

import numpy as np

from bazaarlens.llm import byte_gru
from bazaarlens.llm.queries import QUERIES


def test_backpropagation_equals_differences():
    rng = np.random.default_rng(0)
    tagger = byte_gru.ByteTagger(["a", "b", "c"], h=3)
    x, y = rng.integers(65, 90, (7, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    size = np.array([7, 7, 3, 7, 1])
    params = [tagger.ahead.table, tagger.ahead.inner, tagger.back.table, tagger.back.inner, tagger.out, tagger.bias]

    def loss():
        p, _, _ = tagger.probabilities(x, size)
        return -np.log(p[:, y, np.arange(5)])[np.arange(7)[:, None] < size].mean()

    for p, g in zip(params, tagger._gradients(x, size, y), strict=True):
        flat, own = p.reshape(-1), g.reshape(-1)
        for i in np.argsort(-np.abs(own))[:4]:
            was, eps = flat[i], 1e-2
            flat[i] = was + eps
            up = loss()
            flat[i] = was - eps
            down = loss()
            flat[i] = was
            assert abs((up - down) / (2 * eps) - own[i]) < 2e-3


def test_segments_together_are_texts_alone():
    tagger = byte_gru.ByteTagger(["a", "b"])
    texts = [b"abc", b"x" * 1000, "é".encode() * 200, b"12 .", b"q" * 128]
    flat = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    together = tagger.pooled(flat, ends - [len(t) for t in texts], ends)
    for i, text in enumerate(texts):
        alone = tagger.pooled(np.frombuffer(text, np.uint8), np.array([0]), np.array([len(text)]))
        assert (together[i] == alone[0]).all()
    assert together[3, -1] == 0 and together[1, -1] == 1000


def test_rows_do_not_depend_on_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tagger = byte_gru.ByteTagger(["a", "b", "c"], seed=5)
    one, many = (sorted(map(tuple, byte_gru.predict(docs.repartition(n), tagger).collect())) for n in (1, 17))
    assert one == many and len({r[2] for r in one}) > 1


def test_accepted_languages_and_filled_labels(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, "abc", "x"), (3, "1", None), (4, "zzz", None)], "doc_id long, text string, lang string")
    tagger = byte_gru.ByteTagger(["a", "b"], seed=5)
    told = {r.doc_id: r for r in byte_gru.predict(docs, tagger).collect()}
    kept = byte_gru.accepted(docs, tagger)
    assert sorted(map(tuple, kept.collect())) == [(1, "abc", told[1].lang_pred), (2, "abc", "x"), (4, "zzz", told[4].lang_pred)]
    few = byte_gru.accepted(docs, tagger, {told[1].lang_pred}, told[1].score)
    want = {i for i in (1, 2, 4) if told[i].lang_pred == told[1].lang_pred and told[i].score >= told[1].score}
    assert {r.doc_id for r in few.collect()} == want
    assert byte_gru.fit(docs.drop("lang")) is None and byte_gru.fit(docs.where("lang is null")) is None


def test_query_on_held_out_documents(spark, duck, sf_dir):
    made = {r.doc_id: r for r in QUERIES["op6_byte_gru"](spark, sf_dir).collect()}
    docs = duck.sql("SELECT doc_id, text, lang FROM documents").fetchall()
    assert len(made) == len(docs)
    right, n = 0, 0
    for doc_id, text, lang in docs:
        row = made[doc_id]
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert (row.lang_pred == "und") == (not any(c.isalpha() for c in text or "")) and 0 <= row.score <= 1
        if row.held_out and lang is not None and row.lang_pred != "und":
            right, n = right + (row.lang_pred == lang), n + 1
    assert right >= 0.9 * n > 0


def test_hard_rows(spark, texts, no_texts):
    assert byte_gru.fit(no_texts) is None and byte_gru.predict(no_texts, None).collect() == []
    tagger = byte_gru.ByteTagger(["en", "de"])
    rows = byte_gru.predict(texts, tagger).collect()
    assert len(rows) == 15 and {r.doc_id for r in rows if r.lang_pred == "und"} == {4, 5, 6, 7}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert all(r.lang_pred == "und" for r in byte_gru.predict(texts, None).collect())
    kept = byte_gru.accepted(texts, tagger)
    assert kept.columns == texts.columns and kept.count() == 11
