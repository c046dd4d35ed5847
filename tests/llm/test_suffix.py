import random

import numpy as np
import pytest

from tidelog.llm import suffix

SCHEMA = "doc_id long, text string, start string, spans string, kept string"


def brute(rows, length):
    texts = sorted({(i, (t or "").encode()) for i, t in rows})
    seen, gone = set(), {}
    for i, raw in texts:
        mask = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1):
            key = raw[s: s + length]
            if key in seen:
                mask[s: s + length] = True
            seen.add(key)
        gone[i] = (raw, mask)
    out = []
    for i, _ in rows:
        raw, mask = gone[i]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(int), [0]])))
        out.append((i, len(raw), list(zip(edge[::2].tolist(), edge[1::2].tolist())), bytes(np.frombuffer(raw, np.uint8)[~mask])))
    return sorted(out, key=str)


def got(spark, rows, length):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(4)
    return sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept))
                   for r in suffix.remove_repeats(df, length).collect()), key=str)


def corpus(seed):
    rnd = random.Random(seed)

    def prose(n):
        return "".join(rnd.choice(["the ", "é", "漢", "an", "of ", "x", "\n", "ing "]) for _ in range(n))

    shared = [prose(rnd.randint(10, 120)) for _ in range(6)]
    rows = []
    for i in range(60):
        text = "".join(rnd.choice([prose(rnd.randint(0, 60)), rnd.choice(shared)]) for _ in range(rnd.randint(0, 6)))
        rows.append(((i * 17) % 101, text))
    near = list(rows[7][1] + rows[8][1])
    for k in range(0, len(near), 90):
        near[k] = "#"
    return rows + [(300, "".join(near)), (301, rows[9][1]), (302, rows[9][1]), (303, "ab" * 400), (304, "z" * 300), (305, "y" * 48)]


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True)])
def test_against_brute_force(spark, monkeypatch, seed, hot):
    if hot:  # every anchor counts as frequent
        monkeypatch.setattr(suffix, "frequency_levels", lambda *_: np.ones(1 << 18, np.uint8))
    rows = corpus(seed) + [(400, None), (401, ""), (402, "short"), (303, "ab" * 400)]
    assert got(spark, rows, 48) == brute(rows, 48)


def test_small_chunks_carry_groups_over(spark, monkeypatch):
    monkeypatch.setattr(suffix, "STRINGS_AT_ONCE", 1)
    rows = corpus(3)
    assert got(spark, rows, 60) == brute(rows, 60)


def test_one_passage_in_a_third_of_documents(spark):
    rnd = random.Random(4)
    line = "".join(rnd.choice("abcdefgh ") for _ in range(130))
    rows = [(i, f"{rnd.random()}{rnd.random()}" * 2 + (line if i % 3 == 0 else "") + f"{rnd.random()}" * 3) for i in range(400)]
    assert got(spark, rows, 100) == brute(rows, 100)


def test_documents_without_id_come_first(spark):
    rnd = random.Random(5)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(200))
    out = got(spark, [(None, text), (1, text + "!"), (None, text + "?")], 100)
    kept = {(i, n): spans for i, n, spans, _ in out}
    assert kept[1, 201] == [(0, 200)] and kept[None, 200] + kept[None, 201] in ([(0, 200)],)


def test_ids_are_any_number_and_texts_may_share_one(spark):
    rnd = random.Random(7)
    a, b = ("".join(rnd.choice("abcdefgh ") for _ in range(150)) for _ in range(2))
    least, most = -(1 << 63), (1 << 63) - 1
    rows = [(least, a), (-(1 << 62) - 1, a + b), (-(1 << 62), b), (most, a + "!"), (most, "short"), (most, None), (5, b), (5, a + b), (5, a + b)]
    out = got(spark, rows, 100)
    assert sorted(i for i, *_ in out) == sorted(i for i, _ in rows)
    kept = {(i, n): spans for i, n, spans, _ in out}
    assert kept[least, 150] == [] and kept[-(1 << 62) - 1, 300] == [(0, 150)] and kept[-(1 << 62), 150] == [(0, 150)]
    assert kept[most, 151] == [(0, 150)] and kept[most, 5] == kept[most, 0] == []
    assert kept[5, 150] == [(0, 150)] and kept[5, 300] == [(0, 300)]


def test_of_texts_that_share_an_id_one_keeps_a_string(spark):
    rnd = random.Random(8)
    line = "".join(rnd.choice("abcdefgh ") for _ in range(120))
    out = got(spark, [(3, line + "x" * k) for k in range(4)] + [(2, "other")], 100)
    assert sorted(bool(spans) for i, _, spans, _ in out if i == 3) == [False, True, True, True]


def test_strings_longer_than_a_byte_counts(spark):
    rnd = random.Random(9)
    line = "".join(rnd.choice("abcdefgh ") for _ in range(900))
    rows = [(1, "q" + line), (2, line[:500] + "#" + line[501:]), (3, line[200:]), (4, line[:399])]
    assert got(spark, rows, 400) == brute(rows, 400)


@pytest.mark.parametrize("piece", [700, 1 << 23])
def test_a_long_text_is_cut_for_anchors_only(monkeypatch, piece):
    monkeypatch.setattr(suffix, "PIECE", piece)
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 101, 5000).astype(np.uint8)
    start, count, place, *_ = suffix.anchors(raw, np.array([0, 2000, 2000, 5000]), 60)
    covered = np.concatenate([np.arange(a, a + n) for a, n in zip(start, count)])
    assert covered.tolist() == [*range(0, 2000 - 59), *range(2000, 5000 - 59)]
    assert ((place >= start + count - 1) & (place + suffix.GRAM <= start + 60)).all()


def test_multikey_groups():
    rnd = random.Random(6)
    strings = ["".join(rnd.choice("ab") for _ in range(16)).encode() + bytes(rnd.choice(b"xy") for _ in range(2)) for _ in range(3000)]
    flat = np.frombuffer(b"".join(strings) + bytes(8), np.uint8)
    words = np.zeros(len(flat) - 7, np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | flat[k: len(flat) - 7 + k]
    member, group = suffix.multikey_groups(words, np.arange(3000) * 18, np.zeros(3000, np.int64), 18)
    by = {}
    for m, g in zip(member.tolist(), group.tolist()):
        by.setdefault(g, []).append(strings[m])
    assert all(len(v) > 1 and len(set(v)) == 1 for v in by.values())
    assert len(member) == sum(n for n in map(strings.count, set(strings)) if n > 1)


def test_empty_table_and_bounds(spark):
    assert got(spark, [], 100) == []
    with pytest.raises(ValueError):
        suffix.remove_repeats(spark.createDataFrame([], SCHEMA), 20)
