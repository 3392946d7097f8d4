import numpy as np
import pytest

import corpus_pipeline as pipe
from gridpulse.llm import decontaminate, toxicity
from tests.llm.test_jaccard import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it returned."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (name, stage) in enumerate(pipe.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        kept = spark.read.parquet(path)
        out.append((name, docs, kept))
        docs = kept
    return out


def test_all_but_the_last_return_documents(stages):
    assert [n for n, _, _ in stages] == ["toxicity", "language_id", "jaccard_join", "decontamination", "packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns
        assert after.exceptAll(before).count() == 0


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    _, before, after = stages[0]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after.collect()}
    gone = {r["doc_id"] for r in before.collect()} - kept
    assert gone and np.mean([i in gone for i, t in labels.items() if t == 1]) > 0.8
    assert np.mean([i in kept for i, t in labels.items() if t == 0]) > 0.97


def test_texts_with_letters_stay(stages):
    _, before, after = stages[1]
    want = sorted(r["doc_id"] for r in before.collect() if any(c.isalpha() for c in r["text"] or ""))
    assert sorted(r["doc_id"] for r in after.collect()) == want


def test_one_document_of_each_group_stays(stages):
    _, before, after = stages[2]
    groups = brute([(r["doc_id"], r["text"]) for r in before.collect()])
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({g for g, _ in groups.values()})


def test_documents_with_benchmark_passages_go(spark, stages):
    _, before, after = stages[3]
    matcher = decontaminate.Matcher([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()], 0.05, 24)
    want = sorted(r["doc_id"] for r in before.collect() if not matcher.find(r["text"]))
    assert sorted(r["doc_id"] for r in after.collect()) == want and len(want) < before.count()


def test_all_remaining_documents_are_packed(stages):
    _, before, after = stages[4]
    assert {r["doc_id"] for r in after.select("doc_id").collect()} == {r["doc_id"] for r in before.collect()}


def test_stages_take_odd_rows(spark, odd, none, monkeypatch):
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, **_: toxicity.Model(np.zeros((1, 8)), np.zeros((1, 8, 2)), np.zeros(2), (8,), 0.0))
    docs = odd.select("doc_id", "text", "lang", "source", "score", "block")
    for frame in (docs, none.select(*docs.columns)):
        for _, stage in pipe.STAGES[:-1]:
            assert stage(spark, frame, SF).columns == docs.columns
    kept = pipe.drop_near_copies(spark, docs, SF)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 8, 9]
    assert pipe.drop_toxic(spark, docs, SF).count() == 12
    packed = pipe.pack(spark, docs, SF)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()} and pipe.pack(spark, none.select(*docs.columns), SF).count() == 0


LONG = " ".join(f"word{i}" for i in range(60))
OTHER = " ".join(f"other{i}" for i in range(60))


def _docs(spark, rows):
    return spark.createDataFrame([(*r, "en", "s", i) for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, `row of stage` long").repartition(3)


def test_near_copies_are_decided_by_row(spark):
    docs = _docs(spark, [(1, LONG), (1, OTHER), (2, LONG + " more"), (None, LONG), (None, OTHER), (None, "a text of its own here"),
                         (None, "a text of its own here"), (7, None), (7, None), (8, "")])
    kept = pipe.drop_near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r["row of stage"] for r in kept.collect())[:2] == [0, 1]
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect())
    assert got == sorted([("1", LONG), ("1", OTHER), ("None", "a text of its own here"), ("7", "None"), ("7", "None"), ("8", "")])


def test_contaminated_rows_are_decided_by_row(spark):
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    docs = _docs(spark, [(1, f"before {passage} after"), (1, "a clean text"), (None, f"{passage}"), (None, "another clean text"), (3, None), (4, "")])
    kept = pipe.drop_contaminated(spark, docs, SF)
    assert kept.columns == docs.columns and sorted(r["row of stage"] for r in kept.collect()) == [1, 3, 4, 5]


def test_columns_named_like_results_are_kept(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, **_: toxicity.Model(np.zeros((1, 8)), np.zeros((1, 8, 2)), np.zeros(2), (8,), 0.0))
    docs = _docs(spark, [(1, LONG), (2, OTHER)]).selectExpr("*", "'x' AS `Toxic score`", "'y' AS `language found`", "3 AS `language score`")
    for stage in (pipe.drop_toxic, pipe.drop_unknown_language):
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns and {(r["Toxic score"], r["language found"], r["language score"]) for r in got.collect()} == {("x", "y", 3)}
