import hashlib
import re

import pytest

from tidelog.llm import exact

SCHEMA = "doc_id long, text string, digest string, run int, keep_id string, best string"


def groups(spark, rows, parts=5):
    df = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in exact.exact_groups(df).collect()), key=str)


def brute(rows):
    def bare(t):
        return re.sub(r"[\x20\x09-\x0d]", "", t or "")
    out = []
    for at, (i, t) in enumerate(rows):
        same = [(j, u, k) for k, (j, u) in enumerate(rows) if bare(u) == bare(t)]
        keep, _, row = min(same, key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0, x[2]))
        out.append((i, keep, len(same), row == at, hashlib.sha256(bare(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("parts", [1, 70])
def test_against_brute_force(spark, parts):
    words = ["a b", "ab", " a\tb\x0b", "a\u00a0b", "", None, " \n", "é", "e\u0301", "A B", "x" * 200_000, "x" * 199_999 + " x"]
    rows = [((i * 7) % 40, words[i % len(words)]) for i in range(40)] + [(None, "ab"), (None, "only"), (3, "ab"), (3, "ab")]
    assert groups(spark, rows, parts) == brute(rows)


def test_one_text_in_a_third_of_rows(spark):
    rows = [(i, "same" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    out = groups(spark, rows, 40)
    assert sum(r[3] for r in out) == 2001 and max(r[2] for r in out) == 1000


def test_one_row_of_a_group_stays_whatever_the_ids(spark):
    rows = [(1, "a b c"), (1, "abc"), (2, "x"), (2, "x"), (2, "x"), (None, "y"), (None, "y"), (2 ** 63 - 1, "z"), (-2 ** 63, "z")]
    out = groups(spark, rows)
    assert out == brute(rows) and sum(r[3] for r in out) == 4


def test_empty_table(spark):
    assert groups(spark, []) == []
