import base64
import random

import numpy as np
import pyarrow as pa
import pytest

from tidelog.llm import bpe, cut
from tidelog.llm.queries import vocabulary

tiktoken = pytest.importorskip("tiktoken")
SCHEMA = "doc_id long, text string, ids string, decoded string"
ALPHABET = ["a", "b", "ab", "ha", "he", "h", "aa", "  ", " ", "\n", "\n\n", "é", "ß", "漢", "字", "1", "12", "!", "'s", "'", "'re", "l", "s",
            "t", "r", "e", "😀", "\u0085", "\u00a0", "\u3000", "the", "'l", "\t", "\u0301", "\x00", "<|endoftext|>"]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=cut.KNOWN, mergeable_ranks=bpe.read_ranks(vocabulary()), special_tokens={})


def thue_morse(n):
    """Two words of ``n`` letters for which sums over powers agree modulo 2**64."""
    x = "a"
    while len(x) < n:
        x += x.translate(str.maketrans("ab", "ba"))
    return x, x.translate(str.maketrans("ab", "ba"))


def texts(n=3000):
    rnd = random.Random(3)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_ids_offsets_and_round_trip(spark, reference):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, None), (None, ""), (5, "repeat"), (5, "repeat"), (90_006, "long é漢 " * 40_000),
                                                       (7, "x" * 20_000)]
    df = spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA).repartition(3)
    made = bpe.encode(df, vocabulary(), cut.KNOWN, offsets=True)
    got = sorted(((r.doc_id, list(r.ids)) for r in made.collect()), key=str)
    assert got == sorted(((i, reference.encode_ordinary(t or "")) for i, t in rows), key=str)
    back = bpe.decode(made, vocabulary()).collect()
    assert sorted((str(r.doc_id), r.text, bytes(r.decoded)) for r in back) == sorted((str(i), t or "", (t or "").encode()) for i, t in rows)
    first = made.filter("doc_id = 90006").first()
    whole = "long é漢 " * 40_000
    assert all(reference.decode_bytes([i]).decode(errors="ignore") in whole[s: s + 20] for i, s in zip(first.ids[:500], first.starts[:500]))


def test_split_characters(spark, reference):
    ids = reference.encode_ordinary("𝕏漢")
    starts = bpe.char_starts("𝕏漢".encode(), np.array([len(reference.decode_single_token_bytes(i)) for i in ids]))
    assert starts[0] == 0 and starts[-1] <= 1 and (np.diff(starts) >= 0).all() and len(ids) > 2
    halves = spark.createDataFrame([(1, ids[:1]), (2, ids[1:]), (3, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: r for r in bpe.decode(halves, vocabulary()).collect()}
    assert bytes(got[1].decoded) + bytes(got[2].decoded) == "𝕏漢".encode()
    assert got[1].text.startswith("\ufffd") and got[3].text == ""


def test_every_character_is_cut_as_by_the_pattern(reference):
    sample = [f"a{chr(c)}b {chr(c)}1!{chr(c)}" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    pieces, known = bpe.Pieces(vocabulary()), cut.cutter(cut.KNOWN)
    for at in range(0, len(sample), 20_000):
        part = sample[at: at + 20_000]
        ids, ends = bpe.encode_block(part, known, pieces)
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == [reference.encode_ordinary(s) for s in part]


def test_other_patterns_run_as_they_are():
    some = texts(500)
    for a, b in zip(cut.cutter(cut.KNOWN)(some), cut.cut_by(cut.KNOWN)(some), strict=True):
        assert np.array_equal(a, b)
    with pytest.raises(ValueError):
        cut.cutter("[a-z]+")(["a b"])


def test_forgetting_pieces_changes_nothing(monkeypatch, reference):
    monkeypatch.setattr(bpe.Pieces, "MEMORY", 10)
    pieces, known, some = bpe.Pieces(vocabulary()), cut.cutter(cut.KNOWN), texts(300)
    for t in some:
        assert bpe.encode_block([t], known, pieces)[0].tolist() == reference.encode_ordinary(t)


def test_pieces_that_hash_alike_keep_their_ids(spark, reference, monkeypatch):
    rows = list(enumerate([*thue_morse(1024), " ".join(thue_morse(2048)), "a b", "b a"]))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in bpe.roundtrip(df, vocabulary(), cut.KNOWN).collect()}
    assert all(list(got[i].ids) == reference.encode_ordinary(t) and bytes(got[i].decoded) == t.encode() for i, t in rows)
    # Even if every print were the same.
    monkeypatch.setattr(bpe, "multipliers", lambda n: np.zeros(n, np.uint64))
    known, pieces, some = cut.cutter(cut.KNOWN), bpe.Pieces(vocabulary()), texts(200)
    ids, ends = bpe.encode_block(some, known, pieces)
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [reference.encode_ordinary(s) for s in some]


def test_one_pass_equals_two(spark):
    rows = list(enumerate(texts(300))) + [(None, None), (7, ""), (8, "long é漢 " * 40_000)]
    df = spark.createDataFrame([(*r, "c", "c") for r in rows], SCHEMA).repartition(3)
    one = bpe.roundtrip(df, vocabulary(), cut.KNOWN)
    two = bpe.decode(bpe.encode(df, vocabulary(), cut.KNOWN), vocabulary())
    plain = [sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in x.collect()), key=str) for x in (one, two)]
    assert plain[0] == plain[1] and bpe.roundtrip(df.limit(0), vocabulary(), cut.KNOWN).count() == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert bpe.decode(bpe.encode(df, vocabulary(), cut.KNOWN), vocabulary()).count() == 0


def test_pieces_equal_the_reference_whatever_call_they_fall_into(monkeypatch):
    """Pieces that hold the mark between pieces, in calls of every size, one of them longer than a call."""
    ranks = bpe.read_ranks(vocabulary())
    exact = tiktoken.Encoding("ranks", pat_str=cut.KNOWN, mergeable_ranks=ranks, special_tokens={})
    pieces = ["\n", "\n\n", " \n", "\u00ff", "\u00ff\u00ff", "a", "ab" * 400, " the", "\x00", "\u20ac", "\U0001f600", "\u010a"]
    want = [exact._core_bpe.encode_single_piece(p.encode()) for p in pieces]
    for chars in (1, 3, 1 << 18):
        monkeypatch.setattr(bpe, "CALL_CHARS", chars)
        found = bpe.Pieces(vocabulary())(pieces)
        assert [np.frombuffer(x, np.int32).tolist() for x in found] == want


def test_a_vocabulary_that_lacks_a_byte_is_refused(tmp_path):
    path = tmp_path / "few.tiktoken"
    path.write_text("".join(f"{base64.b64encode(bytes([b])).decode()} {i}\n" for i, b in enumerate(b"abc")))
    pieces = bpe.Pieces(str(path))
    assert [np.frombuffer(x, np.int32).tolist() for x in pieces(["abc", "c"])] == [[0, 1, 2], [2]]
    with pytest.raises(ValueError, match="lacks a byte"):
        pieces(["abd"])


def test_going_on_in_the_same_worker(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts(300))] + [(None, None)], "doc_id long, text string").repartition(3)

    def sizes(batch):
        yield pa.RecordBatch.from_pydict({"n": pa.array([len(x) for x in batch.column("ids").to_pylist()], pa.int64()), "id": batch.column(0)})

    got = bpe.encode(df, vocabulary(), cut.KNOWN, onward=(sizes, "n long, id long")).collect()
    want = bpe.encode(df, vocabulary(), cut.KNOWN).selectExpr("cast(size(ids) as long) n", "doc_id as id").collect()
    assert sorted(got, key=str) == sorted(want, key=str)


def test_known_pieces_stay_in_arrays(monkeypatch, reference):
    """Only new pieces become strings; those that were seen are compared with what is remembered."""
    pieces, known, some = bpe.Pieces(vocabulary()), cut.cutter(cut.KNOWN), texts(300)
    asked, library = [], pieces._library
    monkeypatch.setattr(pieces, "_library", lambda x: asked.extend(x) or library(x))
    for block in (some, some[::-1], some + ["neverseen"]):
        asked.clear()
        ids, ends = bpe.encode_block(block, known, pieces)
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == [reference.encode_ordinary(s) for s in block]
        assert len(asked) == len(set(asked))
    assert asked == ["neverseen"]


def test_remembered_pieces_with_the_print_of_another(monkeypatch, reference):
    monkeypatch.setattr(bpe, "multipliers", lambda n: np.zeros(n, np.uint64))
    known, pieces = cut.cutter(cut.KNOWN), bpe.Pieces(vocabulary())
    for block in (["ab"], ["ba"], ["ab", "ba", "abc"], ["ba"], [""], ["abc", "", "ab"]):
        ids, ends = bpe.encode_block(block, known, pieces)
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == [reference.encode_ordinary(s) for s in block]
    assert len(pieces.prints) == 1
