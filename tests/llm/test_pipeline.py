"""The stages on planted cases."""

import random

import pytest

import corpus_pipeline as pipeline
from tidelog.llm import langid

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, __key string, hits int"
ITEM = "what is the one right answer to this question of all the many questions"


def prose(rnd, n):
    return " ".join("".join(rnd.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(3)) for _ in range(n))


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(1)
    clean = [(i, prose(rnd, rnd.randint(40, 80)), "en") for i in range(60)]
    clean += [(i, "été " + " ".join(rnd.choice(["eau", "ça", "où", "très", "même"]) + rnd.choice(["é", "è", "ç"]) for _ in range(60)), "fr")
              for i in range(60, 100)]
    near = clean[5][1].split()
    near[3] = "other"
    dirty = [(200, None, "en"), (201, "", "en"), (202, "123 456", "en"), (203, clean[4][1].replace(" ", "\n"), "en"),
             (204, " ".join(near), "en"), (205, prose(rnd, 20) + " " + ITEM + " " + prose(rnd, 20), "en"), (206, clean[70][1], None)]
    return clean, dirty


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 1, "clash", 3) for i, t, g in rows], COLUMNS)


def test_each_stage_takes_out_its_own(spark, planted, tmp_path, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 80)
    clean, dirty = planted
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = frame(spark, clean + dirty + [(None, prose(random.Random(9), 50), "en"), (7, clean[7][1], "en")])
    gone, left = [], {r.doc_id for r in docs.collect()}
    for name, step in pipeline.STAGES[:-1]:
        after = step(spark, docs, str(tmp_path))
        assert after.columns == docs.columns, name
        path = str(tmp_path / name)
        after.write.parquet(path)
        docs = spark.read.parquet(path)
        now = {r.doc_id for r in docs.collect()}
        gone.append(left - now)
        left = now
    assert gone == [{200, 201, 202}, {203, 206}, {204}, {205}]
    assert None in left and docs.filter("doc_id = 7").count() == 1
    out = pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert len(out) == docs.count() and all(r.n_tokens == len(r.ids) > 0 for r in out)


def test_empty_tables_pass_through(spark, tmp_path):
    docs = frame(spark, [])
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, step in pipeline.STAGES:
        assert step(spark, docs, str(tmp_path)).count() == 0


def test_rows_without_id_are_decided_one_by_one(spark, planted, tmp_path, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 60)
    clean, _ = planted
    docs = frame(spark, clean + [(None, "", "en"), (None, clean[1][1] + " x", "en"), (None, clean[1][1], "en")])
    kept = pipeline.language(spark, docs, str(tmp_path)).filter("doc_id is null")
    assert sorted(r.text for r in kept.collect()) == sorted([clean[1][1] + " x", clean[1][1]])
    kept = pipeline.exact_duplicates(spark, docs, str(tmp_path)).filter("doc_id is null")
    assert sorted(r.text for r in kept.collect()) == sorted(["", clean[1][1] + " x"])


def test_a_row_loaded_three_times_stays_once(spark, planted, tmp_path):
    clean, _ = planted
    docs = frame(spark, clean[:5] * 3 + [(None, clean[6][1], "en")] * 3)
    for step in (pipeline.exact_duplicates, pipeline.near_duplicates):
        kept = step(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns
        assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
            [(str(i), t) for i, t, _ in clean[:5]] + [("None", clean[6][1])])


def changed(text, word):
    words = text.split()
    words[3] = word
    return " ".join(words)


def test_near_copies_without_id_go(spark, planted, tmp_path):
    clean, _ = planted
    a, b = clean[1][1], clean[2][1]
    docs = frame(spark, [(None, a, "en"), (None, changed(a, "other"), "en"), (3, changed(b, "x"), "en"), (None, b, "en"),
                         (None, clean[3][1], "en"), (None, None, "en"), (None, " ", "en")])
    kept = [(r.doc_id, r.text) for r in pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()]
    assert len(kept) == 5 and (3, changed(b, "x")) in kept and (None, b) not in kept
    assert len({(None, a), (None, changed(a, "other"))} & set(kept)) == 1
    assert {(None, clean[3][1]), (None, None), (None, " ")} <= set(kept)


def test_texts_of_one_id_are_decided_on_one_by_one(spark, planted, tmp_path):
    clean, _ = planted
    a, b = clean[1][1], clean[2][1]
    docs = frame(spark, [(3, a, "en"), (7, changed(a, "other"), "en"), (7, b, "en"), (9, changed(b, "other"), "en")])
    kept = [(r.doc_id, r.text) for r in pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()]
    assert sorted(kept) == [(3, a), (7, b)]
