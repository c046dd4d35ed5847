"""Byte-level BPE over Arrow batches, with character offsets, and its inverse.

The vocabulary is a file of ranks (base64 token, rank).  The tokenizers library
works on characters, so each byte has a character of its own; the same table
read backwards decodes.  Texts are cut by the pattern first and every piece is
encoded on its own, merging the pair of lowest rank, leftmost first.  Equal
pieces of a block of texts go through the library once.

The file must be readable under the same path on every executor.  Each Python
worker loads it once.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.base import small_batches
from tidelog.llm.cut import cutter
from tidelog.llm.words import multipliers

#: Characters of text that are cut and encoded at a time.
BLOCK_CHARS = 1 << 20
#: Ids that are decoded at a time.
BLOCK_IDS = 1 << 19
#: Characters that the library gets at a time; it holds sixteen bytes and more for each.
CALL_CHARS = 1 << 18
#: Stands for no byte in the byte table.
BETWEEN = "\n"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def byte_table() -> list[str]:
    """A character for each byte: printable Latin-1 stands for itself, every other
    byte for the next unused character from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def merges(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """All pairs of tokens that make a token, lowest rank first.

    The rank files merge equal ranks leftmost first, the library by the order of
    pairs.  Both agree if of two splits of one token that can overlap in a text,
    ``u+v`` before ``v+w``, the first is listed first: that is the split whose
    right part the token also starts with.
    """
    out = []
    for token, _ in sorted(ranks.items(), key=lambda x: x[1]):
        splits = [i for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        out += [(token[:i], token[i:]) for i in sorted(splits, key=lambda i: not token.startswith(token[i:]))]
    return out


@functools.lru_cache(maxsize=4)
def encoder(path: str):
    """The library's tokenizer for a rank file; it takes pieces, not texts, in the characters
    of the byte table and with ``BETWEEN`` between them."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's to share out
    from tokenizers import Tokenizer, models, pre_tokenizers

    ranks, table = read_ranks(path), byte_table()
    shown = {token: "".join(table[b] for b in token) for token in ranks}
    made = Tokenizer(models.BPE(vocab={shown[t]: r for t, r in ranks.items()},
                                merges=[(shown[a], shown[b]) for a, b in merges(ranks)], ignore_merges=True, cache_capacity=0))
    made.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(BETWEEN)
    return made


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs of so many each, one run after the other."""
    out = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    out += np.arange(len(out))
    return out


class Pieces:
    """Ids of pieces.  A piece seen before is looked up by its print and compared character
    by character, the others go to the library.

    Only memory depends on ``MEMORY``: beyond about so many bytes it starts anew.
    """

    MEMORY = 64 << 20

    def __init__(self, path: str):
        self.made = encoder(path)
        self.size = np.array([len(t) for t in decoder(path)], np.int64)
        self.shown = np.array([ord(c) for c in byte_table()[:0xFF] + [BETWEEN]], "<u4")
        self._forget()

    def _forget(self) -> None:
        # Prints in order, and for each its piece's characters and ids: where they begin and how many there are.
        self.prints, self.points, self.ids = np.zeros(0, np.uint64), np.zeros(0, "<u4"), np.zeros(0, np.int32)
        self.of = np.zeros((4, 0), np.int64)

    def held(self) -> int:
        return sum(x.nbytes for x in (self.prints, self.points, self.ids, self.of))

    def __call__(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece as 32-bit integers."""
        ids, n = self._library(pieces)
        flat, to = ids.tobytes(), (4 * np.cumsum(n)).tolist()
        return [flat[a:b] for a, b in zip([0, *to[:-1]], to, strict=True)]

    def find(self, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray, prints: np.ndarray, once: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them those of each piece of ``points`` begin and how many there are.
        The first ``once`` pieces differ in their prints and may be remembered."""
        if self.held() > self.MEMORY:
            self._forget()
        slot = np.searchsorted(self.prints, prints)
        taken = np.zeros(len(prints), bool)
        inside = np.flatnonzero(slot < len(self.prints))
        taken[inside] = self.prints[slot[inside]] == prints[inside]
        hit = np.flatnonzero(taken)
        hit = hit[self.of[1, slot[hit]] == sizes[hit]]
        if len(hit):
            z = sizes[hit]
            alike = points[runs(starts[hit], z)] == self.points[runs(self.of[0, slot[hit]], z)]
            hit = hit[np.logical_and.reduceat(alike, np.cumsum(z) - z)]
        at, n = np.zeros(len(prints), np.int64), np.zeros(len(prints), np.int64)
        at[hit], n[hit] = self.of[2:, slot[hit]]
        other = np.ones(len(prints), bool)
        other[hit] = False
        fresh = np.flatnonzero(other)
        if not len(fresh):
            return self.ids, at, n
        z = sizes[fresh]
        new, to = points[runs(starts[fresh], z)], np.cumsum(z)
        whole = new.tobytes().decode("utf-32-le", "surrogatepass")
        made, n[fresh] = self._library([whole[a:b] for a, b in zip((to - z).tolist(), to.tolist(), strict=True)])
        at[fresh] = len(self.ids) + np.cumsum(n[fresh]) - n[fresh]
        keep = np.flatnonzero((fresh < once) & ~taken[fresh])
        keep = keep[np.argsort(prints[fresh[keep]])]
        row = fresh[keep]
        self.of = np.insert(self.of, slot[row], np.stack([len(self.points) + (to - z)[keep], z[keep], at[row], n[row]]), axis=1)
        self.prints = np.insert(self.prints, slot[row], prints[row])
        self.points, self.ids = np.concatenate([self.points, new]), np.concatenate([self.ids, made])
        return self.ids, at, n

    def _library(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, and how many each has."""
        to = np.cumsum(list(map(len, pieces)))
        found, at = [(np.zeros(0, np.int32), np.zeros(0, np.int64))], 0
        while at < len(pieces):
            end = max(at + 1, int(np.searchsorted(to, (to[at - 1] if at else 0) + CALL_CHARS, side="right")))
            found.append(self._learn(pieces[at:end]))
            at = end
        return np.concatenate([x for x, _ in found]), np.concatenate([n for _, n in found])

    def _learn(self, fresh: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One call for many pieces.  Their ids come in one row; the bytes that ids stand for say
        where each piece ends."""
        # No UTF-8 text has the byte 0xFF, so it parts the pieces.
        raw = np.frombuffer("\udcff".join(fresh).encode("utf-8", "surrogateescape"), np.uint8)
        ends = np.append(np.flatnonzero(raw == 0xFF), len(raw)) - np.arange(len(fresh))
        text = self.shown[raw].tobytes().decode("utf-32-le")
        ids = np.array(self.made.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
        reach = np.cumsum(self.size[ids])
        last = np.searchsorted(reach, ends)
        if not len(reach) or reach[-1] != ends[-1] or (reach[last] != ends).any():
            raise ValueError("the vocabulary lacks a byte of the text")
        return ids, np.diff(last, prepend=-1)


@functools.lru_cache(maxsize=4)
def decoder(path: str) -> list[bytes]:
    """Bytes by id, the byte table read backwards; unused ids are empty."""
    back = {c: b for b, c in enumerate(byte_table())}
    vocab = encoder_vocab(path)
    out = [b""] * (max(vocab.values(), default=-1) + 1)
    for shown, rank in vocab.items():
        out[rank] = bytes(back[c] for c in shown)
    return out


def encoder_vocab(path: str) -> dict[str, int]:
    table = byte_table()
    return {"".join(table[b] for b in token): rank for token, rank in read_ranks(path).items()}


def char_starts(raw: bytes, lengths: np.ndarray) -> np.ndarray:
    """For tokens of so many bytes each, the character in which each begins.

    A token that begins inside a character begins in that character, so tokens
    that split one character share its number.
    """
    starts = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=starts[1:])
    lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    return (np.cumsum(lead)[starts] - 1).astype(np.int32)


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    block, size = [], 0
    for t in texts:
        block.append(t)
        size += len(t)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def unequal(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray, place: np.ndarray, like: np.ndarray) -> np.ndarray:
    """The pieces that differ from the piece ``like`` each was taken for, character by character."""
    if not len(starts):
        return np.zeros(0, np.int64)
    same = sizes == sizes[like]
    at = np.repeat(starts[like].astype(place.dtype), sizes)
    at += place
    np.minimum(at, len(points) - 1, out=at)
    return np.flatnonzero(~(same & np.logical_and.reduceat(points[at] == points, starts)))


def encode_block(texts: list[str], cut, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a block of texts, and where in them each text ends."""
    points, starts, owner = cut(texts)
    sizes = np.diff(starts, append=len(points))
    kind = np.int32 if len(points) < 1 << 30 else np.int64
    place = np.arange(len(points), dtype=kind)
    place -= np.repeat(starts.astype(kind), sizes)
    weighed = multipliers(int(sizes.max(initial=0)))[place]
    weighed *= points + np.uint64(1)
    prints = np.add.reduceat(weighed, starts) if len(starts) else np.zeros(0, np.uint64)
    del weighed
    # One piece of each print, whichever, and the print of each piece.
    order = np.argsort(prints)
    new = np.ones(len(prints), bool)
    new[1:] = np.diff(prints[order]) != 0
    first, which = order[new], np.empty(len(prints), np.int64)
    which[order] = np.cumsum(new) - 1
    other = unequal(points, starts, sizes, place, first[which])
    # A piece that only has the print of another stands for itself.
    which[other] = len(first) + np.arange(len(other))
    once, first = len(first), np.concatenate([first, other])
    flat, at, n_of = pieces.find(points, starts[first], sizes[first], prints[first], once)
    n = n_of[which]
    ids = flat[runs(at[which], n)]
    return ids, np.cumsum(np.bincount(owner, weights=n, minlength=len(texts))).astype(np.int64)


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", offsets: bool = False,
           onward: tuple[Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], str] | None = None) -> DataFrame:
    """Token ids of every whole text.

    ``docs`` needs ``key`` and ``text``; other columns are ignored.  Result, one
    row per input row: ``key``, ``ids`` and, with ``offsets``, ``starts`` (the
    character in which each token begins).  Null and empty texts have no ids.

    ``onward`` is a function of a batch of this result, and the schema of the batches it
    gives.  It goes on in the same Python worker, and what it gives is the result.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, cut = Pieces(path), cutter(pattern)
        size = np.array([len(t) for t in decoder(path)], np.int64) if offsets else None
        for batch in batches:
            keys, at = batch.column(0), 0
            for texts in _blocks(batch.column(1).to_pylist()):
                ids, ends = encode_block(texts, cut, pieces)
                each = np.split(ids, ends[:-1])
                columns = {key: keys.slice(at, len(texts)), "ids": lists(each)}
                if offsets:
                    columns["starts"] = lists([char_starts(t.encode(), size[i]) if len(i) else i
                                               for t, i in zip(texts, each, strict=True)])
                at += len(texts)
                made = pa.RecordBatch.from_pydict(columns)
                yield from onward[0](made) if onward else [made]

    more = ", starts array<int>" if offsets else ""
    return rows.mapInArrow(run, onward[1] if onward else f"`{key}` {kind}, ids array<int>{more}")


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=ends[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32, copy=False)))


class Bytes:
    """The bytes of ids, for many ids at once."""

    def __init__(self, path: str):
        known = decoder(path)
        self.size = np.array([len(t) for t in known], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(known), np.uint8)

    def __call__(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes, and how many each id has.  A run of ids may begin or end inside
        a character, so only bytes joined over a whole text are sure to be UTF-8."""
        n = self.size[ids]
        at = np.repeat(self.start[ids] - (np.cumsum(n) - n), n)
        at += np.arange(len(at))
        return self.flat[at], n


def decode(tokens: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Bytes and text of every row of ``ids``.

    Result: ``key``, ``ids``, ``decoded`` (bytes) and ``text``, in which a
    character that the ids hold only in part is U+FFFD.  Null ids are none.  An id outside the
    vocabulary is an error.
    """
    small_batches(tokens.sparkSession)
    rows = tokens.select(F.col(key), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Bytes(path)
        for batch in batches:
            ends = batch.column(1).offsets.to_numpy()
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK_IDS, side="right")) - 1)
                part = batch.slice(at, to - at)
                own = ends[at: to + 1] - ends[at]
                flat, n = read(part.column(1).flatten().to_numpy())
                cut = np.concatenate([[0], np.cumsum(n)])[own]
                joined = flat.tobytes()
                raw = [joined[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    key: part.column(0), "ids": part.column(1), "decoded": pa.array(raw, pa.binary()),
                    "text": pa.array([r.decode("utf-8", "replace") for r in raw], pa.string())})
                at = to

    return rows.mapInArrow(run, f"`{key}` {kind}, ids array<int>, decoded binary, text string")


def roundtrip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """``(key, ids, decoded)``: :func:`encode` and the bytes of :func:`decode` in one pass.

    Ids do not leave their task in between, and a core has one Python worker for both.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, cut, read = Pieces(path), cutter(pattern), Bytes(path)
        for batch in batches:
            keys, at = batch.column(0), 0
            for texts in _blocks(batch.column(1).to_pylist()):
                ids, ends = encode_block(texts, cut, pieces)
                flat, n = read(ids)
                own = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], ends])]
                joined = flat.tobytes()
                raw = [joined[a:b] for a, b in zip(own[:-1].tolist(), own[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({key: keys.slice(at, len(texts)), "ids": lists(np.split(ids, ends[:-1])),
                                                  "decoded": pa.array(raw, pa.binary())})
                at += len(texts)

    return rows.mapInArrow(run, f"`{key}` {kind}, ids array<int>, decoded binary")


def fingerprint(path: str) -> str:
    """Which vocabulary a table of ids was made with."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()
