import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidelog.llm import blocks as B
from tidelog.llm import repair as R
from tidelog.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, edit string, rows string"


def brute_edits(rows):
    """Least (cost, letters) over all edits; ``rows`` of (initial, must go, cut off)."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, last, inserts):
        ways = [(0, "")] if i == len(rows) and last in ("", "a") else []
        if inserts:
            cost, letters = best(i, after[last], inserts - 1)
            ways.append((cost + 2, "I" + letters))
        if i < len(rows):
            initial, must_go, cut_off = rows[i]
            cost, letters = best(i + 1, last, 2)
            ways.append((cost + 3, "D" + letters))
            if not must_go:
                cost, letters = best(i + 1, after[last], 2)
                ways.append((cost + 2 + cut_off, "R" + letters))
                if initial == after[last] or (initial == "s" and last == ""):
                    cost, letters = best(i + 1, initial, 2)
                    ways.append((cost + cut_off, "K" + letters))
        return min(ways, default=(10 ** 9, ""))
    for i in range(len(rows), 0, -50):  # keeps the recursion shallow
        for last in after:
            best(i, last, 2)
    return best(0, "", 2)


def brute(rows):
    """The report of one conversation, straight from the definition; ``rows`` of (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[2])}\n{r[2]}".encode()).digest()))
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                      else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, audit = brute_edits([(r[1][:1], f in ("blank", "duplicate"), f == "truncated")
                               for r, f in zip(rows, faults, strict=True)])
    lines, left, last = [], list(rows), ""
    for letter in audit:
        turn = None if letter == "I" else left.pop(0)
        if letter == "D":
            continue
        role = turn[1] if letter == "K" else "assistant" if last == "u" else "user"
        lines.append(f"{role}:{turn[2] if turn else ''}")
        last = role[:1]
    turns = [r[0] for r in rows if r[0] is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in R.FAULTS[1:]),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def by_conv(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return out


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(parts)


def reported(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_blocks_equal_brute_force():
    t, rnd = B.tables(), random.Random(1)
    kinds = [(i, False, bool(c)) for i in "sua?" for c in (0, 1)]
    for symbols in itertools.chain(*(itertools.product(range(8), repeat=n) for n in range(4)),
                                   (tuple(rnd.choices(range(8), k=rnd.randint(4, 13))) for _ in range(300))):
        edits, state = B.trace(list(symbols), B.START, t.final)
        assert "".join(edits) + B.last_edits(state) == brute_edits([kinds[s] for s in symbols])[1]


def test_pieces_do_what_the_whole_does():
    t, rnd = B.tables(), random.Random(2)
    for _ in range(200):
        whole = rnd.choices(range(8), k=rnd.randint(0, 40))
        at = rnd.randint(0, len(whole))
        vector, ends = B.summary(whole[at:])
        left, state = B.trace(whole[:at], B.START, int(vector[t.final]))
        right, end = B.trace(whole[at:], state, t.final)
        assert (left + right, end) == B.trace(whole, B.START, t.final) and ends[t.final, state] == end


def odd_rows():
    rnd = random.Random(3)
    texts = ["Yes.", "No!", "So", "", " \t", "a\nb?", "é. ", None, "x" * 30]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    rows = [(conv, rnd.choice([None, *range(9)]) if conv % 3 == 0 else turn, rnd.choice(roles), rnd.choice(texts))
            for conv in range(120) for turn in range(rnd.randint(1, 9))]
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Yo."), (-2 ** 63, 1, "user", "long. " * 200_000)]
    return rows + [(500, 3, "user", "Again.")] * 40 + [(501, 4, "assistant", " ")] * 30


def test_reports_equal_brute_force(spark):
    rows = odd_rows()
    got = reported(R.reports(R.repair(frame(spark, rows), size=3)))
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got == {c: brute(own) for c, own in by_conv(plain).items()}
    assert got[500][6] == "K" + "D" * 39 + "I" and got[501][6] == "D" * 30 and got[501][5] == 90


def test_a_conversation_in_many_pieces_and_partitions(spark):
    rnd = random.Random(4)
    rows = [(1, t, rnd.choice(["user", "assistant", "system"]), f"{t}." if rnd.random() < 0.8 else f"{t % 50}") for t in range(600)]
    small = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small, "false")
    try:
        edits = R.repair(frame(spark, [*rows, (2, 0, "user", "A."), (0, 0, "user", "B.")]), size=7)
        assert R.pieces(R.light_rows(frame(spark, rows)), 7).select("part").distinct().count() > 1
        assert reported(R.reports(edits))[1] == brute([r[1:] for r in rows])
        places = [(r.place, r.times) for r in edits.filter("conv_id = 1").orderBy("place").collect()]
    finally:
        spark.conf.set(small, "true")
    assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(places)) and places[0][0] == 0


def test_repaired_turns_have_structure(spark):
    kept = R.repair(R.damage(frame(spark, odd_rows()))).filter("edit <> 'D'")
    roles = {r[0]: "".join(x[1] for x in sorted(r[1])) for r in kept.groupBy("conv_id").agg(
        F.collect_list(F.struct("place", F.substring("role", 1, 1)))).collect()}
    assert all(re.fullmatch("s?(ua)+", s) for s in roles.values()) and len(roles) > 60


@pytest.mark.parametrize("rows", [odd_rows(), [(7, t, "user", f"{t}.") for t in range(300)]])
def test_query_equals_brute_force(spark, folder, rows):
    frame(spark, rows).write.parquet(f"{folder}/conversations.parquet")
    df = QUERIES["op12_conversation_repair"](spark, folder)
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    left = by_conv(damaged(rows))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert reported(df) == {c: brute(left[c]) if c in left else none for c in {r[0] for r in rows}}


def test_empty_table(spark, folder):
    frame(spark, []).write.parquet(f"{folder}/conversations.parquet")
    assert QUERIES["op12_conversation_repair"](spark, folder).collect() == []
