import collections
import glob

import numpy as np
import pyarrow as pa
import pytest

from tidelog.llm import base, queries, shards

KEY, LENGTH = 99, 4
read_shards = shards.read_shards


def by_hand(rows, upper, ids):
    first, last = ids
    most = -(-upper // LENGTH)
    order = shards.Order((last - first + 2) * most, KEY)
    out = []
    for i, own in rows:
        own = [*(own or []), shards.END]
        for j, s in enumerate(range(0, len(own), LENGTH)):
            place = int(order(np.array([(0 if i is None else i - first + 1) * most + j]))[0])
            out.append((place, i, j, own[s: s + LENGTH]))
    return [x[1:] for x in sorted(out, key=lambda x: (x[0], x[3]))]


def read(df):
    return [(r.doc_id, r.part, np.frombuffer(r.tokens, "<u2").tolist()) for r in sorted(df.collect(), key=lambda r: r.slot)]


@pytest.mark.parametrize("n_shards,parts", [(1, 2), (7, 5)])
def test_order_records_and_resumption(spark, tmp_path, n_shards, parts):
    rng = np.random.default_rng(1)
    rows = [(i * 3 - 20, rng.integers(0, 50_000, rng.integers(0, 15)).tolist()) for i in range(60)]
    rows += [(None, [1, 2, 3, 4, 5]), (4000, None), (7, []), (10, [10, 2570, 10, 10])]
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], "doc_id long, ids array<int>, shard string, place int")
    path = str(tmp_path / "shards")
    upper = max(len(r[1] or []) for r in rows) + 1
    shards.write_shards(df.repartition(parts), path, LENGTH, n_shards, KEY, upper, (-20, 4000))
    back = shards.read_shards(spark, path, LENGTH)
    want = by_hand(rows, upper, (-20, 4000))
    assert sorted(read(back), key=str) == sorted(want, key=str)
    got = read(back)
    assert [x[:2] for x in got if x[0] not in (7, 10)] == [x[:2] for x in want if x[0] not in (7, 10)]
    meta = back.collect()
    assert sorted(r.slot for r in meta) == list(range(len(want)))
    # Go on in the middle of the last shard.
    shard = max(r.shard for r in meta)
    own = sorted((r for r in meta if r.shard == shard), key=lambda r: r.slot)
    middle = own[len(own) // 2].slot
    [file] = glob.glob(f"{path}/shard={shard}/part-*.txt")
    with open(file, "rb") as f:
        rest = [(None if i == shards.NO_ID else i, t.tolist()) for i, t in shards.read_from(f, middle, own[0].slot, LENGTH)]
    assert rest == [(r.doc_id, np.frombuffer(r.tokens, "<u2").tolist()) for r in own if r.slot >= middle]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_order_is_a_permutation(size):
    order = shards.Order(size, KEY)
    assert sorted(order(np.arange(size)).tolist()) == list(range(size))
    if size > 100:
        assert not np.array_equal(order(np.arange(size)), shards.Order(size, KEY + 1)(np.arange(size)))


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, ids array<int>")
    shards.write_shards(df, str(tmp_path / "s"), LENGTH, 3, KEY, 1, (0, 0))
    assert glob.glob(str(tmp_path / "s" / "shard=*")) == []


def test_ids_too_far_apart(spark, tmp_path):
    df = spark.createDataFrame([(1, [1])], "doc_id long, ids array<int>")
    with pytest.raises(ValueError):
        shards.write_shards(df, str(tmp_path / "s"), LENGTH, 3, KEY, 9, (0, 1 << 62))


DOCS = ([(None, f"text {i}") for i in range(400)] + [(None, "copied")] * 300 + [(7, f"seven {i}") for i in range(300)]
        + [(1, "x"), ((1 << 63) - 1, "far"), (-(1 << 63) + 1, None), (5, None), (5, "")])


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_rows_have_numbers_of_their_own(spark, monkeypatch, broadcast):
    monkeypatch.setattr(base, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(shards, "PIECE", 7)
    df = spark.createDataFrame([(*r, "clash") for r in DOCS], "doc_id long, text string, number string")
    got = []
    for parts in (1, 6):
        rows, n = shards.numbered(df.repartition(parts))
        got.append(sorted((r.number, r.doc_id, r.text) for r in rows.collect()))
        assert n == len(DOCS) and [x[0] for x in got[-1]] == list(range(n))
    assert got[0] == got[1]
    assert sorted((x[1:] for x in got[0]), key=str) == sorted(DOCS, key=str)


def test_shards_are_even_whatever_the_ids(spark, tmp_path, monkeypatch):
    spark.createDataFrame(DOCS, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(queries, "SHARD_BYTES", sum(len(t or "") for _, t in DOCS) // 7 + 1)
    got = queries.QUERIES["op10_token_shards"](spark, str(tmp_path)).collect()
    assert sorted(r.slot for r in got) == list(range(len(DOCS)))
    sizes = collections.Counter(r.shard for r in got)
    assert len(sizes) == 7 and max(sizes.values()) < 2 * len(DOCS) / 7


def test_texts_are_encoded_and_cut_in_one_worker(spark, tmp_path, monkeypatch):
    """Two Python steps after each other are two workers a core at once."""
    tiktoken = pytest.importorskip("tiktoken")
    reference = tiktoken.Encoding("own", pat_str=queries.cut.KNOWN, mergeable_ranks=queries.bpe.read_ranks(queries.vocabulary()),
                                  special_tokens={})
    rows = [*DOCS, (8, "one two  three\n" * 3_000), (9, "é漢" * 511 + "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    steps, plain, written = [], type(df).mapInArrow, []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *a, **k: steps.append(self) or plain(self, *a, **k))
    monkeypatch.setattr(queries.shards, "read_shards", lambda s, path, *a: written.append(path) or read_shards(s, path, *a))
    got = queries.QUERIES["op10_token_shards"](spark, str(tmp_path))
    assert len(steps) == 2  # to the shards and back
    want = []
    for i, t in rows:
        ids = [*reference.encode_ordinary(t or ""), shards.END]
        want += [(i, j, ids[s: s + queries.SEQUENCE]) for j, s in enumerate(range(0, len(ids), queries.SEQUENCE))]
    assert sorted(read(read_shards(spark, written[0], queries.SEQUENCE)), key=str) == sorted(want, key=str)
    assert got.count() == len(want)


def test_records_of_a_long_row_go_in_batches(spark, tmp_path):
    """More records than a batch holds, from one row and in one shard."""
    rows = [(3, list(range(LENGTH * shards.BATCH * 2 + 2))), (4, []), (None, list(range(LENGTH * shards.BATCH - 1)))]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1)
    upper = max(len(r[1]) for r in rows) + 1
    shards.write_shards(df, str(tmp_path / "s"), LENGTH, 1, KEY, upper, (3, 4))
    assert read(shards.read_shards(spark, str(tmp_path / "s"), LENGTH)) == by_hand(rows, upper, (3, 4))


def test_batches_are_bounded():
    order = shards.Order(1 << 62, KEY)
    row = pa.array([{"doc_id": -5, "number": 7}, {"doc_id": None, "number": None}, {"doc_id": 6, "number": 8}])
    ids = pa.array([[], list(range(LENGTH * shards.BATCH * 2)), [1]], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([row, ids], ["row", "ids"])
    cut = shards._sequences(LENGTH, order, 7, 3000, 9)
    whole = list(cut(batch))
    assert [b.num_rows for b in whole] == [shards.BATCH, shards.BATCH, 3]
    one_by_one = [r for i in range(3) for b in cut(batch.slice(i, 1)) for r in b.to_pylist()]
    assert [r for b in whole for r in b.to_pylist()] == one_by_one
    places = order(np.array([3000, *range(2001), 6000], np.uint64)).tolist()
    assert [(r["place"], r["shard"]) for r in one_by_one] == [(p, p * 9 // order.size) for p in places]
    assert list(cut(batch.slice(0, 0))) == []
