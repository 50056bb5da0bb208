import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
import test_jaccard
import test_line_dedup
import test_pii
from tallyboard.llm import tokens
from tallyboard.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The output of each stage, written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        step(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "PII", "packing"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and df.count() > 100


def test_quality_stage_keeps_good_documents(spark, stages):
    scores = {r.doc_id: r.score for r in QUERIES["op2_quality"](spark, SF).collect()}
    before, after = texts(stages[0]), texts(stages[1])
    assert after == {i: t for i, t in before.items() if scores[i] >= 0.3}


def test_line_stage(stages):
    want = {i: t for i, _, _, t in test_line_dedup.brute(list(texts(stages[1]).items()))}
    assert texts(stages[2]) == want


def test_near_copy_stage(stages):
    before = texts(stages[2])
    groups = {i: c for i, _, c in test_jaccard.brute(list(before.items()), 5, 80)}
    assert texts(stages[3]) == {i: t for i, t in before.items() if groups[i] == i}
    assert len(before) > stages[3].count()


def test_personal_data_is_masked(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    assert not any(test_pii.base_spans(t) for t in after.values())
    assert all(after[i] == t for i, t in before.items() if not any(c in t for c in "@0123456789"))
    assert sum(bool(test_pii.base_spans(t)) for t in before.values()) > 3


def test_packing_holds_every_token(spark, stages):
    library = Tokenizer.from_file(tokens.default_path())
    docs, pieces = texts(stages[4]), defaultdict(list)
    rows = stages[5].collect()
    for r in rows:
        ids = np.array(library.encode(docs[r.doc_id] or "", add_special_tokens=False).ids + [0], "<u4")
        assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and len(ids) == r.doc_tokens
        pieces[r.doc_id].append((r.start, r.length))
    assert set(pieces) == set(docs)
    for i, held in pieces.items():
        assert sum(n for _, n in held) == next(r.doc_tokens for r in rows if r.doc_id == i)
    ran = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sum(r.length for r in ran) == sum(r.length for r in rows) and {key(r)[0] for r in ran} == set(docs)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF)
        assert docs.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect() == []


def test_columns_of_any_name_null_and_repeated_ids(spark, tmp_path):
    """Columns called like those that operators add stay as they were; rows without an id or with one twice are all kept."""
    extra = {"pii_spans": "a", "score": 7.5, "n_lines": None, "n_dropped": 3, "component_id": 1, "id": 9, "odd name`": "x", "n_chars": 12345}
    text = "A good and quite ordinary sentence about the weather in the hills. Mail to jane.doe@example.com for more.\nAnd a second line of it."
    rows = [(1, text), (1, "Another one with other words, nothing more than that."), (None, "No number at all for this text."), (None, None), (2, ""), (3, text)]
    docs = spark.createDataFrame([(i, t, *extra.values()) for i, t in rows], "doc_id long, text string, pii_spans string, score double, n_lines int, n_dropped int, component_id int, id int, `odd name``` string, n_chars long")
    steps = dict(corpus_pipeline.STAGES)
    good = steps["quality classifier"](spark, docs, SF)
    assert good.columns == docs.columns and good.exceptAll(docs).count() == 0
    lined = steps["line dedup"](spark, docs, SF)
    one = steps["n-gram Jaccard join"](spark, lined, SF)
    masked = steps["PII"](spark, one, SF)
    for df, n in ((lined, 6), (one, 5), (masked, 5)):
        found = df.collect()
        assert df.columns == docs.columns and len(found) == n
        for r in found:
            assert {c: r[c] for c in extra if c != "n_chars"} == {c: v for c, v in extra.items() if c != "n_chars"}
            assert r.n_chars == len(r.text or "")
    kept = [(r.doc_id, r.text) for r in masked.collect()]
    assert sorted(str(i) for i, _ in kept) == ["1", "1", "2", "None", "None"]
    assert all("jane.doe" not in (t or "") for _, t in kept)
    assert steps["packing"](spark, masked, SF).agg({"doc_tokens": "min"}).first()[0] == 1
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, docs.limit(0), SF).count() == 0, name


def test_run_removes_what_it_has_read(spark):
    from tallyboard import scratch

    made, dropped = [], []
    write, drop = corpus_pipeline.new_folder, corpus_pipeline.drop_folder
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(corpus_pipeline, "new_folder", lambda *a: made.append(write(*a)) or made[-1])
        patch.setattr(corpus_pipeline, "drop_folder", lambda s, p: dropped.append(p) or drop(s, p))
        assert corpus_pipeline.run(spark, SF).count() > 100
    assert len(made) == 4 and dropped == made[:-1] and scratch.shared_folder(spark) in made[0]
