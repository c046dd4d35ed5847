import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.operators import counts
from tidelog.plans.daily import count_day
from tidelog.sources import lines as L

COUNTED = [
    ('{"type":"a.b.post","action":"create"}', None),
    ('{"type":null,"action":"create"}', None),
    ('  {"type":"a.b.like","action":"delete"} ', None),
    ('{"type":"x","type":"a.b.like","action":"delete"}', None),
    ('{"action":"create"}', "missing type"),
    ('{"type":"a.b.post","action":null}', "null action"),
    ('{"type":"a.b.post"}', "null action"),
    ('{}', "missing type"),
    ('{bad', "malformed"), ('5', "malformed"), ('[]', "malformed"), ('null', "malformed"),
    ('[{"type":"x","action":"create"}]', "malformed"),
    ('{"type":"x","action":"create"} junk', "malformed"),
    ('{"type":"x","action":"create"}}', "malformed"),
    ('{"type":"x","action":"c"} {"type":"y","action":"c"}', "malformed"),
    ('{"type":"x","action":"c"},{"type":"y","action":"c"}', "malformed"),
    ('{"type":"x","action":"c"}] [{"a":1}', "malformed"),
    ("{'type':'x','action':'c'}", "malformed"),
    ('', "malformed"), ('   ', "malformed"),
]


def parsed(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return L.parse_lines(df, schemas.COUNTED, required=("type",), not_null=("action",))


def test_every_line_is_accepted_or_rejected_for_its_reason(spark):
    got = {r.value: r.reject_reason for r in parsed(spark, [v for v, _ in COUNTED]).collect()}
    assert got == dict(COUNTED)


def test_counts_keep_the_null_type_and_fill_zeros(spark):
    good = L.accepted(parsed(spark, [v for v, _ in COUNTED]))
    table = counts.type_action_counts(counts.counts_long(good), ["create", "delete"])
    assert table.columns == ["type", "create", "delete", "other"]
    assert rows(table) == rows(counts.counts_for_actions(good, ["create", "delete"]))
    assert {tuple(r) for r in table.collect()} == {
        ("a.b.post", 1, 0, 0), (None, 1, 0, 0), ("a.b.like", 0, 2, 0)}


def test_no_events_give_an_empty_table(spark):
    assert counts.type_action_counts(counts.counts_long(L.accepted(parsed(spark, ["{bad"])))).count() == 0


def test_columns_follow_the_actions_that_occur(spark):
    long = counts.counts_long(spark.createDataFrame(
        [("a", "create"), ("a", "purge"), ("a", "purge"), ("b", "purge"), (None, "type")], "type string, action string"))
    table = counts.type_action_counts(long)
    assert table.columns == ["type", "create", "purge", "type_2"]
    assert rows(table) == rows(spark.createDataFrame([("a", 1, 2, 0), ("b", 0, 1, 0), (None, 0, 0, 1)], "t string, a int, b int, c int"))
    with pytest.raises(counts.TooManyActions):
        counts.type_action_counts(long, most=2)
    assert counts.type_action_counts(long, ["create"]).columns == ["type", "create", "other"]


def test_any_text_can_be_an_action(spark):
    odd = ["create", "Create", "type", "a`b", "a.b", "", "other"]
    events = spark.createDataFrame([("t", a) for a in odd] + [("t", f"x{i}") for i in range(1500)] + [(None, "create")],
                                   "type string, action string")
    for table in (counts.type_action_counts(counts.counts_long(events), odd, other="other"),
                  counts.counts_for_actions(events, odd, other="other")):
        assert len({c.lower() for c in table.columns}) == len(table.columns) == 9
        got = {r[0]: tuple(r)[1:] for r in table.collect()}
        assert got == {"t": (1,) * 7 + (1500,), None: (1,) + (0,) * 7}


def test_accepted_and_rejected_partition_a_file(spark, folder):
    with open(f"{folder}/day.json", "w") as f:
        f.write("\n".join(v for v, _ in COUNTED) + "\n")
    good, bad = L.ndjson_tolerant_scan(spark, folder, schemas.COUNTED,
                                       required=("type",), not_null=("action",))
    assert good.count() == 4
    assert good.count() + bad.count() == len(COUNTED)


def test_day_counts_from_lines(spark):
    day = spark.createDataFrame([(v,) for v, _ in COUNTED], "value string")
    assert count_day(day).agg(F.sum("create"), F.sum("delete")).first()[:] == (2, 2)


fragments = st.lists(st.sampled_from(
    ['{', '}', '[', ']', ',', ':', '"a"', '"type"', '1', ' ', 'null', '{"type":"x"}']), max_size=7)


@settings(max_examples=5, deadline=None)
@given(st.lists(fragments.map("".join), min_size=40, max_size=40))
def test_same_lines_as_a_json_reader(spark, values):
    def is_object(text):
        try:
            return isinstance(json.loads(text), dict)
        except ValueError:
            return False
    df = spark.createDataFrame([(v,) for v in values], "value string")
    for r in L.parse_lines(df, "type string").collect():
        assert (r.reject_reason is None) == is_object(r.value), r.value
    for r in df.select("value", L.is_json(F.col("value")).alias("ok")).collect():
        try:
            json.loads(r.value)
            assert r.ok, r.value
        except ValueError:
            assert not r.ok, r.value


def test_text_list_is_trimmed(spark, folder):
    with open(f"{folder}/ids.txt", "w") as f:
        f.write(" did:a\t\n\n did:b\n   \ndid:a\n")
    assert rows(L.text_list(spark, folder)) == [("did:a",), ("did:a",), ("did:b",)]
