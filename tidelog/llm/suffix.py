"""Suffix-array dedup: bytes of long strings that occur earlier are removed.

A string is ``length`` consecutive bytes of one document.  Sorting the suffixes
at every byte would move each text a hundred times over, so the suffix array is
sparse: only suffixes at anchors count, and every string has an anchor, the
smallest hash among its grams of ``GRAM`` bytes, which depends on the string
alone.  Consecutive strings with one anchor form a block.

1. Fingerprints of anchors and blocks meet by anchor.  An anchor that occurs once
   is done with.  Of equal blocks only the first can hold new strings; the others
   are removed whole.  Blocks that share an anchor but differ remain.
2. Their suffixes are range-partitioned by leading bytes with splitters that
   Spark samples, and each bucket is sorted by a multikey quicksort.  Equal leads
   are never split between partitions, and a group of leads that reaches over the
   end of an Arrow batch is carried into the next, so equal strings are always
   compared, within a bucket and across its batches.
3. The strings found earlier elsewhere are joined to their documents.

A document is known by ``doc`` and ``tie``: its id and a hash of its text, so that
texts that share an id are told apart.  Without an id ``doc`` is a second hash
and ``tie`` is negative; such documents come before all others.

An anchor that is frequent (counted over all documents) is spread: its
fingerprints by block, and its suffixes by slices of ``SLICE`` strings, led by
the bytes that all strings of the slice share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.base import discard, small_batches, stage
from tidelog.llm.counters import frequency_levels, packed_texts, slots
from tidelog.llm.words import mix, text_blocks

LENGTH = 100
GRAM = 24
SLICE = 8
ANCHORS_PER_BUCKET = 400_000
#: Strings sorted at a time, unless one group of leads has more.
STRINGS_AT_ONCE = 1 << 19
#: Strings whose anchors are sought at a time; a longer text takes several pieces.
PIECE = 1 << 23
_R = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        inverse = pow(_R, -1, 1 << 64)
        for name, base in (("up", _R), ("down", inverse)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Prints:
    """Hashes of any stretch of some bytes."""

    def __init__(self, raw: np.ndarray):
        up, self.down = _powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * np.uint64(_R))

    def grams(self, n: int) -> np.ndarray:
        return mix((self.sums[n:] - self.sums[:-n]) * self.down[:len(self.sums) - n] + np.uint64(n * _R % (1 << 64)))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each ``width`` consecutive entries, by doubling."""
    n, out, have = len(x) - width + 1, x, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:n], out[width - have: width - have + n])


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Blocks of a block of texts: first string, number of strings, place of the
    anchor, hash of the anchor, hash of the block, and text."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int64))
    last = max(len(raw) - length + 1, 0)
    pieces = [_anchors_of_piece(raw, offsets, length, a, min(a + PIECE, last)) for a in range(0, last, PIECE)]
    return tuple(np.concatenate(x) for x in zip(none, *pieces, strict=True))


def _anchors_of_piece(raw, offsets, length, first, last):
    """The blocks of the strings that start in ``[first, last)``."""
    part = raw[first: last + length - 1]
    prints = Prints(part)
    grams = prints.grams(GRAM)
    # High bits: hash; low bits: place, so that of equal hashes the first wins.
    ranked = (grams & ~np.uint64((1 << 24) - 1)) | np.arange(len(grams), dtype=np.uint64)
    least = (_sliding_min(ranked, length - GRAM + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    string = np.arange(first, last)
    inside = text[string] == text[string + length - 1]
    string = string[inside]
    least = least[inside]
    if not len(string):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int64))
    new = np.concatenate([[True], (least[1:] != least[:-1]) | (string[1:] != string[:-1] + 1)])
    start = string[new]
    count = np.diff(np.append(np.flatnonzero(new), len(string)))
    place = least[new]
    block = prints.of(start - first, start - first + count + length - 1)
    block = mix(block + (place - (start - first)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return start, count, place + first, grams[place], block, text[start]


def _route(anchor: np.ndarray, block: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(np.where(hot, anchor ^ mix(block), anchor)) % np.uint64(buckets)).astype(np.int32)


def fingerprints(texts: DataFrame, levels: np.ndarray, length: int, buckets: int) -> DataFrame:
    """Anchors and blocks of every text, packed by bucket."""
    small = np.min_scalar_type(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            docs, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            held = []
            for row, raw, offsets in text_blocks(batch.column(2)):
                start, count, place, anchor, block, text = anchors(raw, offsets, length)
                held.append((anchor, block, docs[row + text], ties[row + text], (start - offsets[text]).astype(np.int32),
                             count.astype(small), (place - start).astype(small)))
            if not held:
                continue
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            bucket = _route(columns[0], columns[1], levels[slots(columns[0])] > 0, buckets)
            order = np.argsort(bucket, kind="stable")
            at = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(at))
            cut = [order[at[i]: at[i + 1]] for i in full]
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(full, pa.int32()),
                "prints": pa.array([b"".join(c[o].tobytes() for c in columns[:2]) for o in cut], pa.binary()),
                "rest": pa.array([pack.compress(b"".join(c[o].tobytes() for c in columns[2:])) for o in cut], pa.binary())})

    return texts.select("doc", "tie", "text").mapInArrow(run, "bucket int, prints binary, rest binary")


SPANS = "kind string, doc long, tie long, start int, n int, place int"


def earliest_first(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, *groups: np.ndarray) -> np.ndarray:
    """The order by groups (the last one first), document and start."""
    return np.lexsort((start, tie, doc, tie >= 0, *groups))


def sort_out(prints: DataFrame, levels: np.ndarray, length: int) -> DataFrame:
    """Blocks that are ``gone``, and those that must be looked at (``look``, or
    ``hot`` where the anchor is frequent); the rest needs nothing."""
    small = np.min_scalar_type(length)
    size = small.itemsize

    def run(_, table):
        unpack = zstandard.ZstdDecompressor()
        held = []
        for p, r in zip(table.column("prints"), table.column("rest"), strict=True):
            p, r = p.as_py(), unpack.decompress(r.as_py())
            m = len(p) // 16
            held.append((np.frombuffer(p, np.uint64, m), np.frombuffer(p, np.uint64, m, 8 * m),
                         np.frombuffer(r, np.int64, m), np.frombuffer(r, np.int64, m, 8 * m),
                         np.frombuffer(r, np.int32, m, 16 * m),
                         np.frombuffer(r, small, m, 20 * m), np.frombuffer(r, small, m, (20 + size) * m)))
        anchor, block, doc, tie, start, n, place = (np.concatenate(x) for x in zip(*held, strict=True))
        order = earliest_first(doc, tie, start, block, anchor)
        anchor, block, doc, tie, start, n, place = (x[order] for x in (anchor, block, doc, tie, start, n, place))
        new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        new_block = new_anchor | np.concatenate([[True], block[1:] != block[:-1]])
        one = np.flatnonzero(new_block)[np.cumsum(new_block) - 1]  # the first of each entry's equal blocks
        gone = (doc != doc[one]) | (tie != tie[one]) | (start != start[one])
        kinds = np.add.reduceat(new_block.astype(np.int64), np.flatnonzero(new_anchor))[np.cumsum(new_anchor) - 1]
        hot = levels[slots(anchor)] > 0
        look = new_block & ((kinds > 1) | hot)
        keep = gone | look
        kind = np.where(gone, "gone", np.where(hot, "hot", "look"))[keep]
        return pa.table({"kind": pa.array(kind.tolist(), pa.string()), "doc": pa.array(doc[keep]),
                         "tie": pa.array(tie[keep]), "start": pa.array(start[keep]), "n": pa.array(n[keep].astype(np.int32)),
                         "place": pa.array(place[keep].astype(np.int32))})

    return prints.groupBy("bucket").applyInArrow(run, SPANS)


def suffixes(packed: DataFrame, spans: DataFrame, length: int) -> DataFrame:
    """The suffixes to compare: leading bytes, and the bytes that their strings cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                doc, tie = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                raw = unpack.decompress(batch.column(2)[i].as_py())
                leads, bytes_, starts, counts, places = [], [], [], [], []
                for s in sorted(set(map(lambda x: (x["kind"], x["start"], x["n"], x["place"]), batch.column(3)[i].as_py()))):
                    kind, start, n, place = s
                    anchor = start + place
                    if kind == "look":
                        leads.append(raw[anchor: anchor + GRAM])
                        pieces = [(start, n)]
                    else:
                        # Slices by the strings' distance to the anchor, the same in every block.
                        far = [anchor - x for x in range(start, start + n)]
                        pieces = []
                        for k in sorted({d // SLICE for d in far}):
                            own = [anchor - d for d in far if d // SLICE == k]
                            pieces.append((own[0], len(own)))
                            leads.append(b"\xff" + raw[anchor - k * SLICE: anchor - k * SLICE + length - SLICE + 1])
                    for at, m in pieces:
                        bytes_.append(raw[at: at + m + length - 1])
                        starts.append(at)
                        counts.append(m)
                        places.append(anchor - at)
                yield pa.RecordBatch.from_pydict({
                    "lead": pa.array(leads, pa.binary()), "bytes": pa.array(bytes_, pa.binary()),
                    "doc": pa.array([doc] * len(leads), pa.int64()),
                    "tie": pa.array([tie] * len(leads), pa.int64()), "start": pa.array(starts, pa.int32()),
                    "n": pa.array(counts, pa.int32()), "place": pa.array(places, pa.int32())})

    listed = spans.filter("kind <> 'gone'").groupBy("doc", "tie").agg(
        F.collect_list(F.struct("kind", "start", "n", "place")).alias("s"))
    return packed.join(listed, ["doc", "tie"]).select("doc", "tie", "packed", "s").mapInArrow(
        run, "lead binary, bytes binary, doc long, tie long, start int, n int, place int")


def multikey_groups(words: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Equal strings: the members of each group of two or more, and the group's number.

    A multikey quicksort that takes eight bytes for a character and all ranges of
    one depth together: each range is parted by its next eight bytes, and ranges
    with one string left need no further bytes.
    """
    member = np.arange(len(at))
    for depth in range(0, length, 8):
        key = words[at[member] + min(depth, length - 8)]
        order = np.lexsort((key, group))
        member, key, group = member[order], key[order], group[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])]) if len(key) else key.astype(bool)
        number = np.cumsum(new) - 1
        many = np.bincount(number)[number] > 1 if len(number) else new
        member, group = member[many], number[many]
    return member, group


def repeated(lead: list[bytes], raw: list[bytes], doc: np.ndarray, tie: np.ndarray, start: np.ndarray, n: np.ndarray,
             place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents (two columns) and starts of strings that start earlier in another suffix of the same lead."""
    flat = np.frombuffer(b"".join(raw) + bytes(8), np.uint8)
    words = np.zeros(len(flat) - 7, np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | flat[k: len(flat) - 7 + k]
    size = np.array([len(r) for r in raw], np.int64)
    begin = np.cumsum(size) - size
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    row = np.repeat(np.arange(len(n)), n)
    number: dict[bytes, int] = {}
    leads = np.array([number.setdefault(x, len(number)) for x in lead], np.int64)
    # Equal strings have their anchor at the same distance.
    group = leads[row] * length + (place[row] - inside)
    member, group = multikey_groups(words, begin[row] + inside, group, length)
    d, t, s = doc[row[member]], tie[row[member]], start[row[member]] + inside[member]
    order = earliest_first(d, t, s, group)
    d, t, s, group = d[order], t[order], s[order], group[order]
    first = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else group.astype(bool)
    one = np.flatnonzero(first)[np.cumsum(first) - 1] if len(group) else group
    later = (d != d[one]) | (t != t[one]) | (s != s[one])
    return d[later], t[later], s[later]


def compare(suffix: DataFrame, length: int) -> DataFrame:
    """Spans of strings that start earlier elsewhere, from sorted buckets of suffixes."""
    def spans(lead, raw, columns):
        d, t, s = repeated(lead, raw, *columns, length)
        order = earliest_first(d, t, s)
        d, t, s = d[order], t[order], s[order]
        new = (np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (s[1:] > s[:-1] + 1)])
               if len(d) else d.astype(bool))
        at = np.flatnonzero(new)
        last = s[np.append(at[1:], len(s)) - 1] if len(at) else s
        return pa.RecordBatch.from_pydict({"doc": pa.array(d[at], pa.int64()), "tie": pa.array(t[at], pa.int64()),
                                           "start": pa.array(s[at], pa.int32()), "n": pa.array(last - s[at] + 1, pa.int32())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        strings = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                # Rows come sorted by lead; a group is complete when the lead changes.
                if strings >= STRINGS_AT_ONCE and row[0] != held[-1][0]:
                    yield spans(*_columns(held))
                    held, strings = [], 0
                held.append(row)
                strings += row[5]
        if held:
            yield spans(*_columns(held))

    return (suffix.repartitionByRange("lead").sortWithinPartitions("lead")
            .mapInArrow(run, "doc long, tie long, start int, n int"))


def _columns(rows: list[tuple]) -> tuple[list, list, list]:
    lead, raw, *rest = zip(*rows, strict=True)
    return list(lead), list(raw), [np.array(x, np.int64) for x in rest]


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Every document without the bytes of strings that start earlier.

    ``docs`` needs ``doc_id`` (a whole number) and ``text``; other columns are
    ignored.  Earlier means in a document with a smaller id, or before in the same.  Null texts are
    empty; texts shorter than ``length`` lose nothing.  Result, one row per input
    row: ``doc_id``, ``n_bytes``, ``spans`` (maximal removed runs of bytes, ends
    exclusive) and ``kept`` (the bytes left, joined).  An id can be any 64-bit number.
    Rows that share ``doc_id`` and text are one document and get the same result;
    different texts of one id, and documents without id, which come before all
    others, are ordered by a hash of their text.
    """
    if not 2 * GRAM <= length <= PIECE // 2:
        raise ValueError(f"strings need at least {2 * GRAM} bytes and at most {PIECE // 2}")
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own, digest = F.col("doc_id").cast("long"), F.xxhash64(text).bitwiseAND(F.lit((1 << 63) - 1))
    rows = docs.select(F.coalesce(own, F.xxhash64(text, F.lit("no id"))).alias("doc"),
                       F.when(own.isNotNull(), digest).otherwise(-1 - digest).alias("tie"), text.alias("text"))
    levels = frequency_levels(rows, lambda raw, offsets: anchors(raw, offsets, length)[3])
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, int(2 * size / (length - GRAM + 2)) // ANCHORS_PER_BUCKET + 1)
    spans = stage(sort_out(fingerprints(rows, levels, length, buckets), levels, length), "spans")
    packed = packed_texts(rows, "doc", "long", tie="long")
    found = stage(suffixes(packed, spans, length), "suffixes")
    removed = stage(spans.filter("kind = 'gone'").select("doc", "tie", "start", "n")
                    .unionByName(compare(found, length)), "removed")
    discard(spans, found)
    listed = removed.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "n")).alias("s"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            n, spans, kept = [], [], []
            for t, s in zip(batch.column(2), batch.column(3), strict=True):
                raw = np.frombuffer(unpack.decompress(t.as_py()), np.uint8)
                delta = np.zeros(len(raw) + 1, np.int64)
                if s.is_valid and len(s):
                    at = s.values.field("start").to_numpy()
                    np.add.at(delta, at, 1)
                    np.add.at(delta, at + s.values.field("n").to_numpy() + length - 1, -1)
                gone = np.cumsum(delta)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                n.append(len(raw))
                spans.append([{"start": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)])
                kept.append(raw[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(n, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(kept, pa.binary())], ["doc", "tie", "n_bytes", "spans", "kept"])

    out = (packed.join(listed, ["doc", "tie"], "left").select("doc", "tie", "packed", "s")
           .mapInArrow(run, "doc long, tie long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"))
    return out.select(F.when(F.col("tie") >= 0, F.col("doc")).cast(kind).alias("doc_id"), "n_bytes", "spans", "kept")

