import pytest

import corpus_pipeline
from tests.llm.test_dedup import near_by_force, repeats_by_force, words_of
from tests.llm.test_formats import packed_well


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    from bazaarlens.session import write_out

    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = write_out(stage(spark, docs, sf_dir), "stage")
        out.append((name, docs, after))
        docs = after
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_each_stage_against_brute_force(stages):
    for name, before, after in stages[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    (_, before, after), *_ = stages
    assert sorted(rows(after)) == sorted(r for r in rows(before) if any(map(str.isalpha, r[1] or "")))

    _, before, after = stages[1]
    groups = {}
    for doc_id, text in rows(before):
        groups.setdefault("".join(text.translate({c: None for c in (32, 9, 10, 11, 12, 13)})), []).append((-len(text), doc_id))
    assert sorted(r[0] for r in rows(after)) == sorted(min(own)[1] for own in groups.values())

    _, before, after = stages[2]
    assert sorted(r[0] for r in rows(after)) == [d for d, _, _, kept in near_by_force(rows(before)) if kept]

    _, before, after = stages[3]
    import hashlib

    left = {d: hashlib.sha256(b" ".join(words_of(t))).hexdigest() for d, t in rows(after)}
    assert left == {d: sha for d, _, _, sha in repeats_by_force(rows(before))}
    assert after.where("n_chars <> length(text)").count() == 0

    _, before, after = stages[4]
    assert packed_well(after.collect(), rows(before)) > 0.95


def test_hard_rows_pass_all_stages(spark, texts, no_texts):
    docs = texts.withColumnRenamed("keep_id", "kept")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "kept"], name
    left = {r.doc_id for r in docs.collect()}
    assert left == {2, 3, 8, 9, 10, 11, 13} or left == {2, 8, 9, 10, 11, 13}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_texts, "").collect() == []


def test_exact_dedup_keeps_by_id_and_text(spark):
    rows = [(None, "one two"), (7, "x y z"), (3, "one two "), (None, "other"), (9, "x y z "), (7, "more"), (7, "more"), (7, "mo re")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.exact_dedup(spark, docs, "").collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(3, "one two "), (9, "x y z "), (None, "other"), (7, "mo re")], key=repr)


def test_language_id_decides_which_documents_share_a_sequence(spark, stages):
    """A sequence holds one language, the one told from the text, also where the given label was missing or wrong."""
    _, before, after = stages[0]
    spoilt = before.selectExpr("doc_id", "text", "if(doc_id % 5 = 0, if(doc_id % 2 = 0, null, 'xx'), lang) AS lang", "source", "n_chars")
    told = corpus_pipeline.language_id(spark, spoilt, "")
    given, found = ({r.doc_id: r.lang for r in df.collect()} for df in (before, told))
    changed = [d for d in found if d % 10 == 0]
    assert sum(found[d] == given[d] for d in changed) >= 0.8 * len(changed) > 0
    packed = corpus_pipeline.packing(spark, after, "").collect()
    language = {r.doc_id: r.lang for r in after.collect()}
    mixed = {}
    for r in packed:
        mixed.setdefault(r.sequence_id, set()).add(language[r.doc_id])
        assert r.lang == language[r.doc_id]
    assert all(len(own) == 1 for own in mixed.values()) and len(set.union(*mixed.values())) > 1
