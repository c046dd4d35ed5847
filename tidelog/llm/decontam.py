"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

An item's windows are runs of ``window`` words; an item of fewer words is one
window.  A document holds a window only if it holds every word of it, so a prefix
of one word is enough to find it by: its rarest, counted over all documents.
Each place of such a word in a document fetches the windows indexed under it;
their length and the word's place in them bound where they could lie, and what
fits is compared word for word, then byte for byte.

The items travel to the documents, never the other way, so documents are not
shuffled and a hot source or passage changes nothing.  Items go in blocks of at
most ``ITEM_BYTES`` of text; more items mean more blocks, each a further pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import words as W
from tidelog.llm.base import small_batches

#: Bytes of item text that travel to every task at a time.
ITEM_BYTES = 4 << 20
RESULT = "n_words long, hits array<struct<start:int,end:int>>, items array<string>"


class Index:
    """The windows of a block of items, found by their rarest word."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        raw = pa.array(texts, pa.string())
        found = [W.split_words(r, o, W.LETTERS_DIGITS) for _, r, o in W.text_blocks(raw, 1 << 62)]
        words = found[0] if found else None
        self.ids, self.by_rarity = ids, None
        rows, sizes, owners = [], [], []
        seen: dict[bytes, int] = {}
        vocab, which = (np.unique(words.hash, return_inverse=True) if words is not None
                        else (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        self.vocab = vocab
        self.spell = [b""] * len(vocab)
        for k, a, b in zip(which.tolist(), words.start.tolist() if words else [], words.end.tolist() if words else [],
                           strict=True):
            self.spell[k] = self.spell[k] or words.low[a:b].tobytes()
        for item in range(len(texts)):
            own = which[words.first[item]: words.first[item + 1]]
            n = min(window, len(own))
            for at in range(len(own) - n + 1 if n else 0):
                content = own[at: at + n].tobytes()
                k = seen.setdefault(content, len(rows))
                if k == len(rows):
                    rows.append(np.pad(own[at: at + n], (0, window - n), constant_values=-1))
                    sizes.append(n)
                    owners.append({item})
                else:
                    owners[k].add(item)
        self.rows = np.array(rows, np.int64).reshape(-1, window)  # numbers of words, -1 after a short window
        self.sizes = np.array(sizes, np.int64)
        self.owners = [sorted(o) for o in owners]

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """The vocabulary number of each word, -1 for a word of no item."""
        if not len(self.vocab):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.vocab, hashes), len(self.vocab) - 1)
        return np.where(self.vocab[at] == hashes, at, -1)

    def order(self, counts: np.ndarray) -> None:
        """Index every window under its rarest word; of equally rare ones, the first by number."""
        if not len(self.rows):
            return
        rank = np.empty(len(counts), np.int64)
        rank[np.lexsort((np.arange(len(counts)), counts))] = np.arange(len(counts))
        ranks = np.where(self.rows >= 0, rank[self.rows], len(counts))
        place = ranks.argmin(axis=1)
        word = self.rows[np.arange(len(place)), place]
        self.by_rarity = np.argsort(word, kind="stable")
        self.place = place
        self.list_start = np.searchsorted(word[self.by_rarity], np.arange(len(self.vocab) + 1))

    def occurrences(self, words: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """All (first word, window) where a window lies in a text of the block."""
        none = np.zeros(0, np.int64)
        if self.by_rarity is None or not len(words.hash):
            return none, none
        number = self.number(words.hash)
        listed = np.where(number >= 0, self.list_start[number + 1] - self.list_start[number], 0)
        spots = np.flatnonzero(listed)
        n = listed[spots]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(spots, n)
        window = self.by_rarity[self.list_start[number[at]] + inside]
        # Positional and length bounds: the whole window lies in the word's own text.
        begin = at - self.place[window]
        text = np.searchsorted(words.first, at, side="right") - 1
        fits = (begin >= words.first[text]) & (begin + self.sizes[window] <= words.first[text + 1])
        begin, window = begin[fits], window[fits]
        for j in range(self.rows.shape[1]):
            inner = j < self.sizes[window]
            same = ~inner
            same[inner] = number[begin[inner] + j] == self.rows[window[inner], j]
            begin, window = begin[same], window[same]
        return self._spelled(words, number, begin, window)

    def _spelled(self, words, number, begin, window):
        """Byte comparison of every word that an occurrence covers."""
        covered = np.unique(np.concatenate([begin + np.minimum(j, self.sizes[window] - 1)
                                            for j in range(self.rows.shape[1])])) if len(begin) else begin
        wrong = [p for p, k, a, b in zip(covered.tolist(), number[covered].tolist(), words.start[covered].tolist(),
                                         words.end[covered].tolist(), strict=True)
                 if words.low[a:b].tobytes() != self.spell[k]]
        if wrong:
            bad = np.cumsum(np.isin(np.arange(len(words.hash) + 1), wrong))
            clean = bad[begin + self.sizes[window] - 1] == np.where(begin > 0, bad[begin - 1], 0)
            begin, window = begin[clean], window[clean]
        return begin, window


def _counts(docs: DataFrame, index: Index) -> np.ndarray:
    """How often each word of the items occurs in all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(index.vocab) + 1, np.int64)
        for batch in batches:
            for _, raw, offsets in W.text_blocks(batch.column(0)):
                total += np.bincount(index.number(W.split_words(raw, offsets, W.LETTERS_DIGITS).hash) + 1,
                                     minlength=len(total))
        seen = np.flatnonzero(total[1:])
        yield pa.RecordBatch.from_pydict({"word": pa.array(seen, pa.int64()), "n": pa.array(total[1:][seen], pa.int64())})

    rows = (docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(len(index.vocab), np.int64)
    for word, n in rows:
        counts[word] = n
    return counts


def _runs(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return [{"start": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


def _search(rows: DataFrame, index: Index, key: str, kind: str) -> DataFrame:
    """Add the hits of one block of items to every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, before_hits, before_items = batch.column(0), batch.column(3), batch.column(4)
            for row, raw, offsets in W.text_blocks(batch.column(1)):
                words = W.split_words(raw, offsets, W.LETTERS_DIGITS)
                begin, window = index.occurrences(words)
                delta = np.zeros(len(words.hash) + 1, np.int64)
                np.add.at(delta, begin, 1)
                np.add.at(delta, begin + index.sizes[window] if len(window) else begin, -1)
                hit = np.cumsum(delta)[:-1] > 0
                n = len(offsets) - 1
                found: list[set] = [set() for _ in range(n)]
                text = np.searchsorted(words.first, begin, side="right") - 1
                for t, w in set(zip(text.tolist(), window.tolist(), strict=True)):
                    found[t].update(index.ids[o] for o in index.owners[w])
                hits, items = [], []
                for t in range(n):
                    own = hit[words.first[t]: words.first[t + 1]].copy()
                    for old in before_hits[row + t].as_py():
                        own[old["start"]: old["end"]] = True
                    hits.append(_runs(own))
                    items.append(sorted(found[t].union(before_items[row + t].as_py())))
                yield pa.RecordBatch.from_arrays([
                    keys.slice(row, n), batch.column(1).slice(row, n), pa.array(np.diff(words.first), pa.int64()),
                    pa.array(hits, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array(items, pa.list_(pa.string()))], [key, "text", "n_words", "hits", "items"])

    return rows.mapInArrow(run, f"`{key}` {kind}, text string, {RESULT}")


def find_items(docs: DataFrame, items: DataFrame, window: int = 10, key: str = "doc_id",
               item_key: str = "item_id") -> DataFrame:
    """Where the windows of benchmark items lie in documents.

    ``docs`` needs ``key`` and ``text``, ``items`` needs ``item_key`` and
    ``text``; other columns are ignored.  Words are lower-cased (A-Z) runs of
    ``0-9a-z`` and non-ASCII characters.  Null and empty texts have no words and
    match nothing; an item without id is searched for under the empty id; rows
    that share an id are one item.  Result, one row per document row: ``key``,
    ``n_words``, ``hits`` (runs of hit words, ends exclusive) and ``items`` (ids
    as strings, sorted by code point).
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema[key].dataType.simpleString()
    listed = items.select(F.coalesce(F.col(item_key).cast("string"), F.lit("")).alias("id"),
                          F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = listed.agg(F.coalesce(F.sum(F.octet_length("text") + 8), F.lit(0))).first()[0]
    blocks = max(1, -(-size // ITEM_BYTES))
    out = rows.select(key, "text", F.lit(0).cast("long").alias("n_words"),
                      F.array().cast("array<struct<start:int,end:int>>").alias("hits"),
                      F.array().cast("array<string>").alias("items"))
    for block in range(blocks):
        own = listed.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        own = sorted(set(own), key=tuple)
        index = Index([r.id for r in own], [r.text for r in own], window)
        index.order(_counts(rows, index))
        out = _search(out, index, key, kind)
    return out.drop("text")
