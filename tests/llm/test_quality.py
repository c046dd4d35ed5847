import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import quality as Q
from tidelog.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, quality string, score string"


def word(rnd):
    return "".join(rnd.choice(["ta", "ko", "mi", "ra", "é", "zu"]) for _ in range(rnd.randint(1, 4)))


def text(good, rnd, n=None):
    n = n or rnd.randint(5, 60)
    words = [word(rnd) for _ in range(n)]
    if good:
        return " ".join(w.capitalize() if i % 7 == 0 else w + "." if i % 7 == 6 else w for i, w in enumerate(words))
    return rnd.choice([lambda: "\n".join(words), lambda: " ".join(w + "$$$" for w in words),
                       lambda: " ".join(w.upper() + "!!" for w in words), lambda: " ".join([words[0]] * n)])()


def tables(n=400, seed=1):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good = rnd.random() < 0.7
        docs.append((i, text(good, rnd), None))
        labels.append((i, int(good)))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame([(*r, "clash", "clash") for r in docs], SCHEMA).repartition(4),
            spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int"))


def brute_score(model, body):
    """One text's score, straight from the definition of its n-grams."""
    raw = np.frombuffer(body.encode(), np.uint8)
    at, shares = Q.vector(raw)
    return 1 / (1 + np.exp(-float(model.weights[at].astype(float) @ shares)))


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = tables()
    rnd = random.Random(2)
    odd = [(900, None, None), (901, "", None), (902, " \n\t", None), (None, text(True, rnd, 30), None), (5, text(False, rnd, 30), None),
           (903, text(True, rnd, 40_000), None), (904, "x" * 300_000, None)]
    more = [(900, 0), (None, 1), (5, None), (5, 1), (6, 7), (12345, 1), (1, labels[1][1])]
    d, lab = frames(spark, docs + odd, labels + more)
    got = Q.classify(d, lab).collect()
    assert len(got) == len(docs) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    by_id = {r.doc_id: r for r in got}
    assert not by_id[None].held_out and by_id[903].predicted == 1
    assert by_id[900].score == by_id[901].score == by_id[902].score


def test_scores_are_sparse_dot_products(spark):
    docs, labels = tables(150, 3)
    d, lab = frames(spark, docs, labels)
    model = Q.train(Q.sample(d, lab, ~Q.held_out()))
    assert 50 < (model.weights != 0).sum()
    for r in Q.predict(d, model).collect():
        body = docs[r.doc_id][1]
        assert r.score == pytest.approx(brute_score(model, body), abs=1e-4)


def test_only_texts_enter_a_score(spark):
    docs, labels = tables(120, 4)
    d, lab = frames(spark, docs, labels)
    model = Q.train(Q.sample(d, lab, ~Q.held_out()))
    other, _ = frames(spark, [(i + 1000, t, "zz") for i, t, _ in docs], [])
    plain = {r.doc_id: round(r.score, 9) for r in Q.predict(d, model).collect()}
    moved = {r.doc_id - 1000: round(r.score, 9) for r in Q.predict(other.repartition(7), model).collect()}
    assert plain == moved


def test_labels_of_held_out_documents_change_nothing(spark):
    docs, labels = tables(200, 5)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    a, b = ({r.doc_id: r.score for r in Q.classify(*frames(spark, docs, own)).collect()} for own in (labels, turned))
    assert a == b


def test_sample_is_bounded_and_copies_take_one_place(spark):
    docs, labels = tables(300, 6)
    copies = [(1000 + i, docs[0][1], None) for i in range(2000)]
    marks = labels + [(i, labels[0][1]) for i, _, _ in copies]
    d, lab = frames(spark, docs + copies, marks)
    got = Q.sample(d, lab, F.lit(True), per_label=40)
    kinds = [label for _, _, label, _ in got]
    assert kinds.count(0) == kinds.count(1) == 40 and all(len(at) <= Q.FEATURES + 1 for at, *_ in got)
    assert len({at.tobytes() for at, *_ in got}) == 80
    weights = {label: w for *_, label, w in got}
    assert weights[1] / weights[0] == pytest.approx(sum(q for _, q in labels) / sum(1 - q for _, q in labels))


def test_ngrams_stay_inside_their_text():
    raw, offsets = np.frombuffer(b"a bc. D  e", np.uint8), np.array([0, 6, 6, 10])
    block = [[f[o == i].tolist() for f, o in Q.features(raw, offsets)] for i in range(3)]
    alone = [[f.tolist() for f, _ in Q.features(raw[a:b], np.array([0, b - a]))] for a, b in zip(offsets, offsets[1:])]
    assert block == alone and [len(x) for x in block[0]] == [2, 1, 2, 1, 0]


def test_nothing_to_learn_and_empty_tables(spark, folder):
    d, lab = frames(spark, [(1, "abc", None)], [(1, 1)])
    assert Q.classify(d, lab.limit(0)).first().score == 0.5
    d.limit(0).write.parquet(f"{folder}/documents.parquet")
    lab.write.parquet(f"{folder}/labels.parquet")
    df = QUERIES["op11_quality_classifier"](spark, folder)
    assert df.columns == ["doc_id", "held_out", "score", "predicted"] and df.count() == 0
