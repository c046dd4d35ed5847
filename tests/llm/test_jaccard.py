import random
import re

import pytest

from tidelog.llm import counters, jaccard
from tidelog.llm.links import components

SCHEMA = "doc_id long, text string, n string, node string, digest string"


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(n, len(w))
    return {tuple(w[i: i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(rows, rule):
    sets = [shingles(t, rule.n) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= rule.percent * (len(sets[i]) + len(sets[j]) - both):
                label[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for d in members[find(i)] if d is not None]
        out.append((doc, len(sets[i]), doc if not sets[i] else min(ids, default=None)))
    return sorted(out, key=str)


def got(spark, rows, rule):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in jaccard.similar_groups(df, rule).collect()), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(25):
        base = [rnd.choice(words) for _ in range(rnd.choice([3, 6, 9, 14, 20, 30, 60, 120]))]
        for _ in range(rnd.randint(1, 6)):
            copy = list(base)
            for _ in range(rnd.randint(0, 3)):
                at = rnd.randrange(len(copy))
                copy[at: at + rnd.randint(0, 1)] = [rnd.choice(words)] * rnd.randint(0, 2)
            rows.append((len(rows) * 3 % 997, " ".join(copy)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,rule,short", [(1, jaccard.Rule(4, 85), 32), (2, jaccard.Rule(5, 80), 2), (3, jaccard.Rule(1, 60), 2)])
def test_against_brute_force(spark, monkeypatch, seed, rule, short):
    monkeypatch.setattr(jaccard, "SHORT_LIST", short)
    odd = [(2000, None), (2001, ""), (2002, " \n"), (2003, "one"), (2004, "ONE "), (None, "one"), (None, "no id at all here"),
           (None, None), (2005, "same id a b c d"), (2005, "same id a b c d")]
    rows = corpus(seed) + odd
    assert got(spark, rows, rule) == brute(rows, rule)


@pytest.mark.parametrize("light", [0, 12, 24])
def test_any_boundary_gives_the_same(spark, monkeypatch, light):
    monkeypatch.setattr(jaccard, "light_boundary", lambda *_: light)
    rows = [r for r in corpus(4) if len(r[1].split()) <= 20]
    assert got(spark, rows, jaccard.Rule(2, 80)) == brute(rows, jaccard.Rule(2, 80))


def test_one_passage_in_all_and_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SHORT_LIST", 5)
    rnd = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(30))
    base = [f"b{i}" for i in range(80)]
    rows = [(i, passage + " " + " ".join(f"x{rnd.randrange(10**6)}" for _ in range(rnd.randint(5, 40)))) for i in range(80)]
    for i in range(80, 200):
        copy = list(base)
        copy[rnd.randrange(80)] = f"y{i}"
        rows.append((i, " ".join(copy)))
    assert got(spark, rows, jaccard.Rule(4, 85)) == brute(rows, jaccard.Rule(4, 85))


def test_near_copies_around_the_threshold_do_not_become_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SHORT_LIST", 5)
    monkeypatch.setattr(jaccard, "SLICE", 64, raising=False)
    monkeypatch.setattr(jaccard, "AT_ONCE", 3, raising=False)
    rnd = random.Random(6)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(300):
        copy = list(base)
        # Two copies with one word changed each link, with three between them they do not, but folded sketches may say so.
        for at in rnd.sample(range(4, 116), 1 + (i % 3 > 0)):
            copy[at] = f"y{i}-{at}"
        rows.append((i, " ".join(copy)))
    staged, stage = {}, jaccard.stage

    def counting(df, name):
        out = stage(df, name)
        staged[name] = max(staged.get(name, 0), out.count())
        return out

    monkeypatch.setattr(jaccard, "stage", counting)
    rule = jaccard.Rule(4, 85)
    assert got(spark, rows, rule) == brute(rows, rule)
    # 1,223 when all pairs of components were listed.
    assert staged["pairs"] < 2 * len(rows)


def test_sketches_never_rule_out_a_link():
    import numpy as np
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 300)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 63, rng.integers(0, 40)).astype(np.uint64)]))
        x, y = (np.frombuffer(jaccard.parity(s), np.uint64) for s in (a, b))
        w = min(len(x), len(y))
        apart = int(np.bitwise_count(jaccard.fold(x, w) ^ jaccard.fold(y, w)).sum()) if w else 0
        assert apart <= len(np.setxor1d(a, b))


def test_components_of_a_long_chain(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1000), (5, 5)], "a long, b long")
    got = dict((r.node, r.component) for r in components(links).collect())
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}


def test_counters_cover_every_document(spark):
    import numpy as np
    rows = spark.createDataFrame([(f"a b c d e {i}",) for i in range(500)], "text string").repartition(7)
    levels = counters.frequency_levels(rows, jaccard.shingle_hashes(5))
    assert (levels > 0).sum() >= 1 and levels.dtype == np.uint8


def test_empty_table(spark):
    assert got(spark, [], jaccard.Rule()) == []
    assert got(spark, [(1, None)], jaccard.Rule()) == [(1, 0, 1)]


def test_words_that_hash_alike_do_not_link(spark):
    x = "a"
    while len(x) < 2048:
        x += x.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{x} p q r s"), (2, f"{x.translate(str.maketrans('ab', 'ba'))} p q r s")]
    rule = jaccard.Rule(n=4, percent=85)
    assert got(spark, rows, rule) == brute(rows, rule) == [(1, 2, 1), (2, 2, 2)]


def test_ids_are_names_only(spark):
    base = [f"w{i}" for i in range(40)]
    a, b, near_b = " ".join(base), " ".join(f"v{i}" for i in range(40)), " ".join([f"v{i}" for i in range(39)] + ["z"])
    rule = jaccard.Rule(n=4, percent=85)
    # Rows of id 7 have two texts and bring both groups together.
    assert got(spark, [(3, a), (7, a), (7, b), (9, near_b)], rule) == [(3, 37, 3), (7, 37, 3), (7, 37, 3), (9, 37, 3)]
    ends = [(2 ** 63 - 1, a), (-2 ** 63, a), (2 ** 62, b), (2 ** 62 + 1, near_b), (None, near_b), (-2 ** 62, "only these words here")]
    assert got(spark, ends, rule) == brute(ends, rule)
    many = [(None, " ".join(f"{k}-{i}" for i in range(12))) for k in range(300)]
    assert got(spark, many + many[:5], rule) == brute(many + many[:5], rule)


def test_a_very_long_text(spark):
    rnd = random.Random(9)
    long = [f"w{rnd.randrange(5000)}" for _ in range(60_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:-2000])), (3, " ".join(long[30_000:]))]
    rule = jaccard.Rule(n=5, percent=80)
    assert got(spark, rows, rule) == brute(rows, rule)
