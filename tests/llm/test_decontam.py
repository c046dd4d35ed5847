import random
import re

import pytest

from tidelog.llm import decontam



def thue_morse(n):
    x = "a"
    while len(x) < n:
        x += x.translate(str.maketrans("ab", "ba"))
    return x, x.translate(str.maketrans("ab", "ba"))


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, hits string, items string, n_words string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    out = []
    for i, text in docs:
        own, hit, found = words(text), set(), set()
        for item, it in items:
            w = words(it)
            n = min(window, len(w))
            for at in range(len(w) - n + 1 if n else 0):
                for p in range(len(own) - n + 1):
                    if own[p: p + n] == w[at: at + n]:
                        hit.update(range(p, p + n))
                        found.add("" if item is None else str(item))
        out.append((i, len(own), sorted(hit), sorted(found)))
    return sorted(out, key=str)


def got(spark, docs, items, window):
    d = spark.createDataFrame([(*r, "x", "y", "z") for r in docs], DOCS).repartition(3)
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, id string")
    rows = decontam.find_items(d, b, window).collect()
    return sorted(((r.doc_id, r.n_words, [p for h in r.hits for p in range(h.start, h.end)], list(r["items"])) for r in rows), key=str)


@pytest.mark.parametrize("block", [4 << 20, 60])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "ITEM_BYTES", block)
    rnd = random.Random(1)
    vocabulary = ["a", "b", "C", "dé", "e1", "ß", "f", "漢"]

    def text(n):
        return "".join(rnd.choice(vocabulary) + rnd.choice([" ", ",", "\n", ". "]) for _ in range(n))

    docs = [(i, text(rnd.randint(0, 60))) for i in range(150)] + [(None, None), (None, "a b C"), (3, ""), (3, ""), (500, text(20_000))]
    items = [(i % 12, text(rnd.choice([0, 2, 3, 5, 7]))) for i in range(15)] + [(None, "dé e1 ß"), (40, None), (40, "...")]
    assert got(spark, docs, items, 4) == brute(docs, items, 4)


def test_windows_do_not_cross_documents_or_items(spark):
    assert got(spark, [(1, "a b"), (2, "c d")], [(1, "b c")], 2) == [(1, 2, [], []), (2, 2, [], [])]
    assert got(spark, [(1, "b c")], [(1, "a b"), (2, "c d")], 2) == [(1, 2, [], [])]


def test_words_that_hash_alike_stay_apart(spark):
    x, y = thue_morse(2048)
    docs, items = [(1, f"p {x} q"), (2, f"p {y} q")], [(1, x), (2, y)]
    assert got(spark, docs, items, 10) == brute(docs, items, 10)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a b")], 2) == []
    assert got(spark, [(1, "a b")], [], 2) == [(1, 2, [], [])]
