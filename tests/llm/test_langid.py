import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import langid as L

SYLLABLES = {"aa": ["ta", "ko", "mi", "ra"], "bb": ["sch", "ung", "ei", "ß"], "cc": ["été", "eau", "oi", "ç"]}
SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string"


def prose(lang, n, rnd):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(n))


def table(n=300):
    rnd = random.Random(1)
    return [(i, prose(lang, rnd.randint(3, 60), rnd), lang) for i in range(n) for lang in [rnd.choice(list(SYLLABLES))]]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def test_gradients_are_right():
    model = L.initial(["a", "b", "c"], hidden=3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    codes, lengths, truth = np.random.default_rng(0).integers(0, 256, (6, 4)), np.array([6, 5, 3, 1]), np.array([0, 1, 2, 1])
    _, grad = L.gradients(model, codes, lengths, truth)
    for name, g in grad.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        model.weights[name][at] += 1e-5
        up = L.gradients(model, codes, lengths, truth)[0]
        model.weights[name][at] -= 2e-5
        down = L.gradients(model, codes, lengths, truth)[0]
        model.weights[name][at] += 1e-5
        assert (up - down) / 2e-5 == pytest.approx(g[at], rel=1e-4), name


def test_held_out_accuracy_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(L, "STEPS", 60)
    odd = [(900, None, None), (901, "", "aa"), (902, "123 !?", "bb"), (None, prose("aa", 20, random.Random(2)), "cc"),
           (5, "ta", "aa"), (903, prose("bb", 30_000, random.Random(3)), None)]
    rows = table() + odd
    got = {(r.doc_id, r.held_out): r for r in L.identify(frame(spark, rows)).collect()}
    truth = {i: lang for i, _, lang in rows[:300]}
    held = [r for (i, h), r in got.items() if h and i in truth]
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == h for i, h in got if i is not None) and len(held) > 30
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    by_id = {i: r for (i, _), r in got.items()}
    assert [by_id[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by_id[900].score == 0
    assert by_id[None].lang_pred == "aa" and not by_id[None].held_out and by_id[903].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_sources_and_ids_are_no_inputs(spark):
    model = L.train([(prose(k, 20, random.Random(i)).encode(), k) for i in range(10) for k in SYLLABLES], steps=15)
    rows = table(40)
    plain = L.predict(frame(spark, rows), model).collect()
    other = L.predict(frame(spark, [(i + 1000, t, "zz") for i, t, _ in rows]).repartition(5), model).collect()
    assert sorted((r.doc_id, r.lang_pred, round(r.score, 5)) for r in plain) == \
        sorted((r.doc_id - 1000, r.lang_pred, round(r.score, 5)) for r in other)


def test_positions_follow_the_text(spark):
    rnd = random.Random(4)
    model = L.train([(prose(k, 30, rnd).encode(), k) for _ in range(40) for k in SYLLABLES], steps=120)
    text = prose("aa", 60, rnd) + " " + prose("cc", 60, rnd)
    runs = L.predict(frame(spark, [(1, text, None)]), model, positions=True).first().runs
    longest = {}
    for a, b in zip(runs, [*runs[1:], None]):
        end = b.start if b else len(text.encode())
        longest[a.lang] = longest.get(a.lang, 0) + end - a.start
    assert runs[0].start == 0 and set(sorted(longest, key=longest.get)[-2:]) == {"aa", "cc"}


def test_sample_is_bounded_and_excludes_held_out(spark):
    rows = table(300)
    df = frame(spark, rows)
    got = L.sample(df, ~L.held_out(), per_language=7)
    texts = {t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5}
    assert len(got) <= 3 * 7 * L.SNIPPETS and all(any(c.decode() in t for t in texts) for c, _ in got)


def test_copies_take_no_places_in_the_sample(spark):
    rnd = random.Random(6)
    others = [(i, prose("aa", 8, rnd), "aa") for i in range(100)]
    copied = spark.range(10_000).selectExpr("id + 1000 AS doc_id", f"'{prose('aa', 8, rnd)}' AS text", "'aa' AS lang")
    df = frame(spark, others).select("doc_id", "text", "lang").unionByName(copied)
    got = L.sample(df, F.lit(True), per_language=20)
    assert len({cut.decode() for cut, _ in got}) == 20


def test_nothing_to_learn(spark):
    df = frame(spark, [(1, "abc", None)])
    assert L.identify(df).first().lang_pred == "und" and L.identify(df.limit(0)).count() == 0
