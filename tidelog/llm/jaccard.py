"""N-gram Jaccard join: documents whose sets of word shingles are similar.

Two sets of sizes ``a`` and ``b`` link when their overlap is at least
``need(a, b)``.  The join is aware of sizes:

* Light sets, up to a boundary, list every subset of the size that a partner
  would have to share.  Sharing one proves the link, and the smallest set of a
  list is linked to all that have any link there.
* Heavy sets are found through inverted lists of their first tokens in one
  order of all tokens; two sets with enough overlap share one of those.  Lists
  are scanned with bounds on size and place, and on the difference of the sets
  from their parity sketches; what is left is compared exactly.

The boundary is where listing subsets begins to cost more than scanning lists.

What keeps hot groups small: equal sets are one node, whatever their number and ids.
A node has a number of its own; ids, of which some may be missing or shared, only name the groups in the end.
Tokens are ordered by counters over all documents, the frequent ones last, so a
passage in a third of all documents is in hardly any set's first tokens.  From a
long list only a spanning forest of what folded sketches allow is compared first.
A tree whose edges all hold is one component and done with.  Of the others a
second forest is compared, by whole sketches and between components.  Where that
has edges that do not hold either, the whole sets meet in their list, and every pair of
different components that sketches allow is compared there; only links that join
components leave it.  So no list sends its pairs; of more than ``SLICE`` members there
every one is sent once per slice.  No pair of
different sets that could be linked is left out otherwise, and no list has a cap.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import words as W
from tidelog.llm.base import checked, discard, small_batches, stage
from tidelog.llm.counters import frequency_levels, packed_texts, slots
from tidelog.llm.links import components

#: Largest set for which subsets are ever considered.
MOST_LIGHT = 24
#: Lists up to this length are compared pair by pair at once.
SHORT_LIST = 32
#: Members of a list whose whole sets meet in one group; longer lists meet slice by slice.
SLICE = 1024
#: Whole sets that are compared with one set at a time.
AT_ONCE = 256
#: First tokens of sets that one task of the list scan gets, on average.
TOKENS_PER_BUCKET = 400_000


@dataclass(frozen=True)
class Rule:
    """Link when ``100 * overlap >= percent * union`` over shingles of ``n`` words."""

    n: int = 5
    percent: int = 80

    def need(self, a, b):
        """Smallest overlap that links sets of sizes ``a`` and ``b``."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def least(self, a):
        """Smallest size of, and smallest overlap with, any partner of a set of size ``a``."""
        return -(-self.percent * a // 100)

    def first(self, a):
        """How many first tokens of a set are enough to find it by."""
        return a - self.least(a) + 1

    def subset_sizes(self, a: int, most: int) -> list[int]:
        """The overlaps that light partners of a set of size ``a`` need."""
        top = min(most, 100 * a // self.percent)
        return sorted({self.need(a, b) for b in range(max(1, self.least(a)), top + 1)} - {0})


def token_sets(column: pa.Array, n: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Per block of texts: its first row and each text's distinct shingles, in hash order."""
    for row, raw, offsets in W.text_blocks(column):
        words = W.split_words(raw, offsets, W.BLANK_SEPARATED)
        yield row, [np.unique(W.shingles(words.hash[a:b], n))
                    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)]


def shingle_hashes(n: int):
    """All shingles of a block, for the counters; those across two texts change no order that matters."""
    def of(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        hashes = W.split_words(raw, offsets, W.BLANK_SEPARATED).hash
        return W.shingles(hashes, n) if len(hashes) >= n else hashes[:0]
    return of


def parity(tokens: np.ndarray) -> bytes:
    """A sketch of a set: one bit per token place, flipped by each token.

    The bits in which two sketches differ are at most the tokens in which the sets do.
    """
    # Four to eight bits a token: few tokens flip a bit back, so that sets just
    # under the threshold are seen to be too far apart.
    bits = max(64, 1 << (4 * len(tokens) - 1).bit_length())
    flips = np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


def narrow(sketch: bytes) -> bytes:
    """A sketch folded to a quarter: it travels with every pair and member of a list, the
    whole one only with what the quarter cannot rule out."""
    whole = np.frombuffer(sketch, np.uint64)
    return fold(whole, max(1, len(whole) // 4)).tobytes()


def fold(sketch: np.ndarray, to: int) -> np.ndarray:
    """The sketch the same set would have with ``to`` 64-bit words (along the last axis)."""
    while sketch.shape[-1] > to:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


SETS = "doc_id {kind}, n int, digest binary, first binary, sketch binary, narrow binary"


def digest_of(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def sets_of(docs: DataFrame, rule: Rule, levels: np.ndarray, kind: str) -> DataFrame:
    """Per document: size and digest of its set, its first tokens, and its sketch.

    Light sets come with all their tokens.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets in token_sets(batch.column(1), rule.n):
                firsts, digests, sketches, halves = [], [], [], []
                for s in sets:
                    k = len(s) if len(s) <= MOST_LIGHT else rule.first(len(s))
                    level = levels[slots(s)]
                    ordered = s[np.argsort(level, kind="stable")] if level.any() else s
                    firsts.append(ordered[:k].tobytes())
                    digests.append(digest_of(s))
                    sketches.append(parity(s) if len(s) else b"")
                    halves.append(narrow(sketches[-1]) if len(s) else b"")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(sets)), pa.array([len(s) for s in sets], pa.int32()),
                     *(pa.array(x, pa.binary()) for x in (digests, firsts, sketches, halves))],
                    ["doc_id", "n", "digest", "first", "sketch", "narrow"])

    return docs.mapInArrow(run, SETS.format(kind=kind))


def light_boundary(nodes: DataFrame, rule: Rule) -> int:
    """The size up to which listing subsets is cheaper than scanning lists.

    Both are counted in rows handled: subsets of each size, against first tokens
    times the mean length of the list that such a token is in.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(0).to_numpy()
            tokens = [np.frombuffer(x.as_py(), np.uint64)[:rule.first(k)].astype(np.int64)
                      for k, x in zip(n.tolist(), batch.column(1), strict=True)]
            yield pa.RecordBatch.from_pydict({"token": pa.array(np.concatenate([np.zeros(0, np.int64), *tokens]), pa.int64())})

    small = nodes.filter((F.col("n") > 0) & (F.col("n") <= MOST_LIGHT))
    sizes = dict(small.groupBy("n").count().collect())
    lists = (small.select("n", "first").mapInArrow(run, "token long").groupBy("token").count()
             .agg(F.sum(F.col("count") * F.col("count")), F.sum("count")).first())
    mean = (lists[0] or 0) / max(lists[1] or 0, 1)

    def light(n: int, x: int) -> int:
        return sum(comb(n, c) for c in rule.subset_sizes(n, x))

    def cost(x: int) -> float:
        return (sum(k * light(n, x) for n, k in sizes.items() if n <= x)
                + sum(k * rule.first(n) * (1 + mean) for n, k in sizes.items() if n >= rule.least(x + 1)))

    return min(range(MOST_LIGHT + 1), key=lambda x: (cost(x), x))


def list_entries(nodes: DataFrame, rule: Rule, most: int, buckets: int) -> DataFrame:
    """Entries of subset lists and inverted lists, packed by the bucket of their key.

    ``place`` is the place of a token in its set's order, or minus the size of a subset.
    """
    reach = rule.least(most + 1)  # light sets from here on may link to heavy ones

    def entries(n: int, tokens: np.ndarray) -> tuple[list, list]:
        keys, places = [], []
        if n <= most:
            for c in rule.subset_sizes(n, most):
                subsets = np.array(list(itertools.combinations(np.sort(tokens), c)), np.uint64)
                keys.append(_subset_keys(subsets))
                places.append(np.full(len(subsets), -c))
        if n >= reach:
            keys.append(tokens[:rule.first(n)])
            places.append(np.arange(len(keys[-1])))
        return keys, places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            keys, places, counts = [], [], []
            sizes = batch.column(1).to_pylist()
            for n, x in zip(sizes, batch.column(2), strict=True):
                k, p = entries(n, np.frombuffer(x.as_py(), np.uint64))
                keys += k
                places += p
                counts.append(sum(map(len, k)))
            if not sum(counts):
                continue
            key, place = np.concatenate(keys), np.concatenate(places).astype(np.int32)
            node = np.repeat(batch.column(0).to_numpy(), counts)
            n = np.repeat(np.array(sizes, np.int32), counts)
            bucket = (W.mix(key) % np.uint64(buckets)).astype(np.int32)
            order = np.lexsort((key, bucket))
            at = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(at))
            cut = [order[at[i]: at[i + 1]] for i in full]
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(full, pa.int32()), "keys": pa.array([key[c].tobytes() for c in cut], pa.binary()),
                "rest": pa.array([pack.compress(node[c].tobytes() + n[c].tobytes() + place[c].tobytes()) for c in cut],
                                 pa.binary())})

    return nodes.select("node", "n", "first").mapInArrow(run, "bucket int, keys binary, rest binary")


def _subset_keys(subsets: np.ndarray) -> np.ndarray:
    return W.mix(W.shingles_of_rows(subsets))


def _unpacked(table: pa.Table) -> tuple[np.ndarray, ...]:
    unpack = zstandard.ZstdDecompressor()
    keys, nodes, sizes, places = [], [], [], []
    for k, r in zip(table.column("keys"), table.column("rest"), strict=True):
        keys.append(np.frombuffer(k.as_py(), np.uint64))
        m, rest = len(keys[-1]), unpack.decompress(r.as_py())
        nodes.append(np.frombuffer(rest, np.int64, m))
        sizes.append(np.frombuffer(rest, np.int32, m, 8 * m))
        places.append(np.frombuffer(rest, np.int32, m, 12 * m))
    return tuple(np.concatenate(x) for x in (keys, nodes, sizes, places))


FOUND = "kind string, a long, b long, key long, n int, place int"


def scan_lists(entries: DataFrame, rule: Rule) -> DataFrame:
    """What the lists say: proven links (``link``), pairs to compare (``pair``), and
    the members of long lists (``long``: node ``a`` of list ``key``)."""
    def run(_, table):
        key, node, n, place = _unpacked(table)
        order = np.lexsort((node, n, key))
        key, node, n, place = (x[order] for x in (key, node, n, place))
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        end = np.append(start[1:], len(key))
        links, pairs, long = set(), set(), []
        for a, b in zip(start[end - start > 1].tolist(), end[end - start > 1].tolist(), strict=True):
            if place[a] < 0:
                linked = rule.need(n[a], n[a:b]) <= -place[a]
                links.update((min(node[a], x), max(node[a], x)) for x in node[a:b][linked].tolist() if x != node[a])
            elif b - a <= SHORT_LIST:
                i, j = np.triu_indices(b - a, 1)
                i, j = i + a, j + a
                ok = (rule.least(n[j]) <= n[i]) & (np.minimum(n[i] - place[i], n[j] - place[j]) >= rule.need(n[i], n[j]))
                lo, hi = np.minimum(node[i], node[j])[ok], np.maximum(node[i], node[j])[ok]
                pairs.update((x, y) for x, y in zip(lo.tolist(), hi.tolist(), strict=True) if x != y)
            else:
                long.append(np.arange(a, b))
        long = np.concatenate(long) if long else np.zeros(0, np.int64)
        both = [("link", x) for x in links] + [("pair", x) for x in pairs - links]
        m, k = len(both), len(long)
        return pa.table({
            "kind": pa.array([x for x, _ in both] + ["long"] * k, pa.string()),
            "a": pa.array([int(x[0]) for _, x in both] + node[long].tolist(), pa.int64()),
            "b": pa.array([int(x[1]) for _, x in both] + [None] * k, pa.int64()),
            "key": pa.array([None] * m + key[long].view(np.int64).tolist(), pa.int64()),
            "n": pa.array([None] * m + n[long].tolist(), pa.int32()),
            "place": pa.array([None] * m + place[long].tolist(), pa.int32())})

    return entries.groupBy("bucket").applyInArrow(run, FOUND)


def sketch_pairs(table: pa.Table, rule: Rule) -> Iterator[tuple[int, np.ndarray]]:
    """Members of a long list, ordered by size, with the later ones that place and
    sketch allow.  ``table``: ``n, place, component, sketch``; a component's own pairs are left out."""
    n, place, component = (table.column(c).to_numpy() for c in ("n", "place", "component"))
    sketches = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("sketch")]
    width = np.array([len(s) for s in sketches])
    folded = {w: np.stack([fold(s, w) for s in sketches[np.searchsorted(width, w): np.searchsorted(width, 2 * w, "right")]])
              for w in np.unique(width).tolist()}
    top = np.searchsorted(n, 100 * n.astype(np.int64) // rule.percent, side="right")
    for i in range(len(n)):
        j = np.arange(i + 1, top[i])
        j = j[component[j] != component[i]]
        need = rule.need(n[i], n[j].astype(np.int64))
        keep = np.minimum(n[i] - place[i], n[j] - place[j]) >= need
        j, need = j[keep], need[keep]
        if len(j):
            own, base = folded[width[i]], np.searchsorted(width, width[i])
            apart = np.bitwise_count(own[j - base] ^ own[i - base]).sum(axis=1)
            yield i, j[apart <= n[i] + n[j] - 2 * need]


def forests(members: DataFrame, rule: Rule) -> DataFrame:
    """Pairs that first connect two components of a list, with the list and the ``tree`` they end up in.

    ``members``: ``key, node, n, place, sketch, component``.  Two components of which any
    members' sketches allow a link are in one tree.  Every member that has such a
    partner in another component is there too, paired with itself.
    """
    def run(key, table):
        table = table.sort_by([("n", "ascending"), ("node", "ascending")])
        node, component = (table.column(c).to_numpy() for c in ("node", "component"))
        root = {x: x for x in component.tolist()}

        def find(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        out, partnered = [], np.zeros(len(node), bool)
        for i, later in sketch_pairs(table, rule):
            partnered[later] = True
            partnered[i] |= len(later) > 0
            for k, c in zip(node[later].tolist(), component[later].tolist(), strict=True):
                x, y = find(int(component[i])), find(c)
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((x, min(int(node[i]), k), max(int(node[i]), k)))
        out += [(c, x, x) for c, x in zip(component[partnered].tolist(), node[partnered].tolist(), strict=True)]
        return pa.table({"key": pa.array([key[0].as_py()] * len(out), pa.int64()),
                         "tree": pa.array([find(x) for x, _, _ in out], pa.int64()),
                         "a": pa.array([x for _, x, _ in out], pa.int64()), "b": pa.array([x for _, _, x in out], pa.int64())})

    return members.groupBy("key").applyInArrow(run, "key long, tree long, a long, b long")


def broken(trees: DataFrame, groups: DataFrame) -> DataFrame:
    """``key, tree, node, component`` of the trees whose nodes are not all in one component."""
    ends = stage(trees.filter("a = b").select("key", "tree", F.col("a").alias("node")).join(groups, "node", "left")
                 .withColumn("component", F.coalesce("component", "node")), "tree-ends")
    several = (ends.groupBy("key", "tree").agg(F.min("component").alias("x"), F.max("component").alias("y"))
               .filter("x <> y").select("key", "tree"))
    return stage(ends.join(several, ["key", "tree"], "left_semi"), "broken-trees")


def sliced(members: DataFrame) -> DataFrame:
    """``members`` of trees with ``slice``, their own, and ``one`` and ``two``, the slices that meet.

    A tree of up to ``SLICE`` members is one slice; in a larger one every two slices meet once.
    """
    slices = members.groupBy("key", "tree").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("slices"))
    own = (members.join(slices, ["key", "tree"])
           .withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")))
    return (own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
            .withColumn("one", F.least("slice", "other")).withColumn("two", F.greatest("slice", "other")).drop("slices", "other"))


def joining_links(members: DataFrame, rule: Rule) -> DataFrame:
    """Links that join components of a tree, by comparison of whole sets.

    ``members``: ``key, tree, one, two, slice, node, n, place, component, sketch, tokens``.
    All pairs that sketches allow are compared as long as they are in different components.
    """
    def run(_, table):
        table = table.sort_by([("n", "ascending"), ("node", "ascending")])
        node, component, own = (table.column(c).to_numpy() for c in ("node", "component", "slice"))
        mixed = table.column("one")[0].as_py() != table.column("two")[0].as_py()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("tokens")]
        size = np.array([len(s) for s in sets])
        label = component.copy()
        out = []
        for i, later in sketch_pairs(table, rule):
            if mixed:
                later = later[own[later] != own[i]]
            while len(later := later[label[later] != label[i]]):
                now, later = later[:AT_ONCE], later[AT_ONCE:]
                tokens = np.concatenate([sets[j] for j in now.tolist()])
                at = np.minimum(np.searchsorted(sets[i], tokens), size[i] - 1)
                both = np.add.reduceat((sets[i][at] == tokens).astype(np.int64), np.cumsum(size[now]) - size[now])
                for j in now[both >= rule.need(size[i], size[now])].tolist():
                    if label[j] != label[i]:
                        label[label == label[j]] = label[i]
                        out.append((int(node[i]), int(node[j])))
        return pa.table({"a": pa.array([min(x) for x in out], pa.int64()), "b": pa.array([max(x) for x in out], pa.int64())})

    return members.groupBy("key", "tree", "one", "two").applyInArrow(run, "a long, b long")


def near_enough(pairs: DataFrame, sketches: DataFrame, rule: Rule, column: str = "sketch") -> DataFrame:
    """Pairs whose sketches do not rule out a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, sa, sb = (batch.column(i) for i in range(6))
            sizes = zip(na.to_pylist(), nb.to_pylist(), sa, sb, strict=True)
            ok = []
            for x, y, s, t in sizes:
                s, t = np.frombuffer(s.as_py(), np.uint64), np.frombuffer(t.as_py(), np.uint64)
                w = min(len(s), len(t))
                ok.append(int(np.bitwise_count(fold(s, w) ^ fold(t, w)).sum()) <= x + y - 2 * rule.need(x, y))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    left = sketches.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col(column).alias("sa"))
    right = sketches.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col(column).alias("sb"))
    return (pairs.select("a", "b").distinct().join(left, "a").join(right, "b")
            .select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long"))


def whole_sets(texts: DataFrame, rule: Rule) -> DataFrame:
    """``(node, tokens)`` of ``(node, digest, held)``, a text or a compressed one.

    Rows that share an id may have several texts; one whose set is not the node's is passed over.
    """
    compressed = texts.schema["held"].dataType.simpleString() == "binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            held = batch.column(2)
            if compressed:
                held = pa.array([unpack.decompress(x.as_py()).decode() for x in held], pa.string())
            for row, sets in token_sets(held, rule.n):
                digests = batch.column(1).slice(row, len(sets)).to_pylist()
                own = pa.array([digest_of(s) == d for s, d in zip(sets, digests, strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(sets)).filter(own),
                                                  pa.array([s.tobytes() for s in sets], pa.binary()).filter(own)], ["node", "tokens"])

    return texts.select("node", "digest", "held").mapInArrow(run, "node long, tokens binary")


def nameless_sets(texts: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The same for texts without id, which only their digest leads to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in token_sets(batch.column(0), rule.n):
                yield pa.RecordBatch.from_arrays([pa.array([digest_of(s) for s in sets], pa.binary()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], ["digest", "tokens"])

    return (texts.select("text").mapInArrow(run, "digest binary, tokens binary")
            .join(nodes.select("node", "digest"), "digest").select("node", "tokens"))


def compared(pairs: DataFrame, tokens: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose whole sets overlap enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                ok.append(both >= rule.need(len(x), len(y)))
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    left = tokens.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = tokens.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def similar_groups(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The group of similar texts of every document.

    ``docs`` needs ``doc_id`` (a whole number) and ``text``; other columns are
    ignored.  Words are runs of characters other than blanks, A-Z lower-cased; a
    text of fewer than ``rule.n`` words is one shingle; a text without words, or
    null, has an empty set and links with nothing.  Result, one row per input row:
    ``doc_id``, ``n_shingles`` and ``component_id``, the smallest ``doc_id``
    reachable by links.  Rows that share a ``doc_id`` are one document, which has the links of
    all of them; documents without id link like others, and a group of
    nothing else has no ``component_id``.  An id can be any 64-bit number.
    """
    small_batches(docs.sparkSession)
    kind = "long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    levels = frequency_levels(rows, shingle_hashes(rule.n))
    every = stage(sets_of(rows, rule, levels, kind), "shingle-sets")
    # Equal sets are one node.  Its number is written down, so it stays the same.
    found = every.filter("n > 0")
    classes = stage(found.groupBy("digest", "n").agg(F.min("doc_id").alias("least"))
                    .withColumn("node", F.monotonically_increasing_id()), "set-classes")
    own = classes.select(F.col("digest").alias("_digest"), "least", "node")
    picked = found.join(own, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("least")))
    nodes = stage(picked.dropDuplicates(["node"]).select("node", "n", "digest", "first", "sketch", "narrow"), "set-nodes")
    names = stage(every.select("doc_id", "n", "digest"), "set-members")
    discard(every)

    most = light_boundary(nodes, rule)
    tokens = nodes.agg(F.sum(F.octet_length("first") / 8)).first()[0] or 0
    buckets = max(64, int(tokens // TOKENS_PER_BUCKET) + 1)
    lists = stage(scan_lists(list_entries(nodes, rule, most, buckets), rule), "lists")
    sketches = stage(nodes.select("node", "n", "sketch", "narrow"), "sketches")
    discard(nodes)
    proven = lists.filter("kind = 'link'").select("a", "b").unionByName(same_id(names, classes))
    # Members of long lists stay light on disk; a folded sketch joins them on the way to their list.
    members = lists.filter("kind = 'long'").select("key", F.col("a").alias("node"), "n", "place")
    folded = sketches.select("node", F.col("narrow").alias("sketch"))

    def sets_at(ends: DataFrame) -> DataFrame:
        """The whole sets of the nodes in question, from their texts."""
        ends = stage(classes.join(ends, "node", "left_semi").select("node", "digest", F.col("least").alias("doc_id")), "ends")
        # Few of them are broadcast; otherwise texts are shuffled once, compressed.
        named, nameless = rows.filter(F.col("doc_id").isNotNull()), rows.filter(F.col("doc_id").isNull())
        few = checked(ends)
        held = (named.join(few, "doc_id").withColumnRenamed("text", "held") if few is not ends else
                packed_texts(named, "doc_id", kind).join(ends, "doc_id").withColumnRenamed("packed", "held"))
        wanted = whole_sets(held, rule).unionByName(nameless_sets(nameless, ends.filter("doc_id is null"), rule))
        whole = stage(wanted.dropDuplicates(["node", "tokens"]), "whole-sets")
        discard(ends)
        return whole

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs that link: exact comparison."""
        whole = sets_at(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        links = stage(compared(pairs, whole, rule), "links")
        discard(whole)
        return links

    trees = stage(forests(members.join(folded, "node").withColumn("component", F.col("node")), rule), "trees")
    listed = near_enough(lists.filter("kind = 'pair'"), sketches, rule, "narrow")
    pairs = stage(near_enough(listed.unionByName(trees.filter("a < b").select("a", "b")), sketches, rule), "pairs")
    links = verified(pairs).unionByName(proven)
    groups = components(links)
    # A tree whose nodes are all in one component needs nothing more; others are looked at by whole sketches.
    rest = broken(trees, groups)
    discard(trees)
    if rest.limit(1).count():
        whole = sketches.select("node", "sketch")
        again = stage(forests(rest.drop("tree").join(members, ["key", "node"]).join(whole, "node"), rule), "trees")
        more = again.filter("a < b").select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti")
        links = links.unionByName(verified(stage(more, "pairs")))
        groups = components(links)
        rest = broken(again, groups)
        discard(again)
    if rest.limit(1).count():
        tokens = sets_at(rest.select("node").distinct())
        meeting = sliced(rest.join(members, ["key", "node"])).join(whole, "node").join(tokens, "node")
        found = stage(joining_links(meeting, rule), "links")
        discard(tokens)
        if found.limit(1).count():
            groups = components(links.unionByName(found))
    discard(sketches, pairs)

    label = classes.join(groups, "node", "left").select(
        "digest", "n", "least", F.coalesce("component", "node").alias("component"))
    least = label.groupBy("component").agg(F.min("least").alias("component_id"))
    label = stage(label.join(least, "component").select("digest", "n", "component_id"), "set-labels")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (names.join(label, ["digest", "n"], "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id")))


def same_id(names: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the different sets that rows of one id have."""
    several = (names.filter("n > 0 and doc_id is not null").groupBy("doc_id")
               .agg(F.min("digest").alias("x"), F.max("digest").alias("y")).filter("x <> y").select("doc_id"))
    own = (names.filter("n > 0").join(several, "doc_id").join(classes.select("digest", "node"), "digest")
           .select("doc_id", "node").distinct())
    first = own.groupBy("doc_id").agg(F.min("node").alias("a"))
    return own.join(first, "doc_id").filter("node <> a").select("a", F.col("node").alias("b"))
