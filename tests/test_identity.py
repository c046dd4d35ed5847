from conftest import rows
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.functions import records
from tidelog.operators import endpoints, identity
from tidelog.plans import crawl, discovery
from tidelog.sources import operations

NEW = '{"did":"d1","createdAt":"2025-01-01T00:00:00.1Z","operation":{"services":{"atproto_pds":{"endpoint":"https://n"}}}}'
LINES = [
    NEW, NEW,
    '{"did":"d2","operation":{"services":{"atproto_pds":{"endpoint":""}},"service":"https://l1"}}',
    '{"did":"d3","operation":{"services":null,"service":"https://l2"}}',
    '{"did":"d4","operation":{"services":{"atproto_pds":null},"service":"https://l3"}}',
    '{"did":"d5","operation":{}}',
    '{"did":"d6","operation":{"services":{"atproto_labeler":{"endpoint":"https://lab"}}}}',
    '{"did":"","operation":{"services":{"atproto_labeler":{}}}}',
    '{"operation":{"services":{"atproto_labeler":{}}}}',
    'atproto_labeler {bad',
]


def text(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_servers(spark):
    ops = identity.parse_operations(text(spark, LINES))
    assert rows(identity.distinct_pds(ops)) == [
        ("https://l1",), ("https://l2",), ("https://l3",), ("https://n",)]
    failed = spark.createDataFrame([("https://l2",)], "pds string")
    assert rows(crawl.servers_to_list(text(spark, LINES), failed)) == [
        ("https://l1",), ("https://l3",), ("https://n",)]


def test_labelers(spark):
    assert rows(discovery.labelers(text(spark, LINES))) == [("d6",)]


def test_pages_are_appended_and_deduplicated_by_line(spark):
    page = text(spark, LINES[:2])
    both = operations.append_pages(page, page)
    assert both.count() == 4
    assert operations.distinct_lines(both).count() == 1


def test_cursor(spark):
    ops = identity.parse_operations(text(spark, LINES))
    assert operations.resume_created_at(ops).first()[0] == "2025-01-01T00:00:00.1Z"
    assert operations.resume_created_at(ops.limit(0)).first()[0] == ""
    assert operations.newer_than(ops, "").count() == ops.count()
    assert operations.newer_than(ops, "2025-01-01T00:00:00.1Z").count() == 0


def test_caught_up(spark):
    ops = spark.sql("SELECT timestamp'2025-01-01 00:00:00' AS created_at")
    for as_of, want in (("2025-01-01 00:01:00", True), ("2025-01-01 00:01:00.000001", False)):
        assert operations.caught_up(ops, as_of).first()[0] is want
    assert operations.caught_up(ops.limit(0), "2025-01-01 00:00:00").first()[0] is True


VIEWS = [("d1", [("h1",), (None,), ("",)], 1), ("d2", [("h1",), ("h2",)], 2), ("d3", None, 3)]
DOCS = [
    ("d1", [("AtprotoLabeler", "https://one.example")]),
    ("d2", [("Other", "x"), ("AtprotoLabeler", "https://two.example/"), ("AtprotoLabeler", "second")]),
    ("d4", [("AtprotoLabeler", None), ("AtprotoLabeler", "second")]),
    ("d5", []), ("d6", None),
]


def views(spark):
    return spark.createDataFrame([(d, None if v is None else [{"creator": {"handle": h[0]}} for h in v], o)
                                  for d, v, o in VIEWS], f"did string, views {schemas.VIEWS}, ord bigint")


def docs(spark):
    return spark.createDataFrame(DOCS, f"did string, service {schemas.SERVICES}")


def test_last_writer_of_a_handle_wins(spark):
    flat = identity.explode_views(views(spark))
    assert rows(flat.select("did", "handle")) == [("d1", "h1"), ("d2", "h1"), ("d2", "h2")]
    assert rows(identity.handle_did_map(flat)) == [("h1", "d2"), ("h2", "d2")]


def test_first_service_ends_the_search(spark):
    got = docs(spark).select("did", records.first_service_of_type(F.col("service")).alias("e"))
    assert {r.did: r.e for r in got.collect()} == {
        "d1": "https://one.example", "d2": "https://two.example/", "d4": None, "d5": None, "d6": None}


def test_every_handle_keeps_its_row(spark):
    handles = spark.createDataFrame([("h1", "d1"), ("h4", "d4"), ("h9", "d9")], "handle string, did string")
    assert rows(identity.labeler_endpoints(handles, docs(spark))) == [
        ("h1", "d1", "https://one.example"), ("h4", "d4", None), ("h9", "d9", None)]


def test_several_documents_of_an_account_give_one_row(spark):
    handles = spark.createDataFrame([("h1", "d1")], "handle string, did string")
    twice = docs(spark).withColumn("v", F.lit(1)).unionByName(
        docs(spark).withColumn("service", F.expr("transform(service, s -> struct(s.type, 'https://new.example' AS serviceEndpoint))"))
        .withColumn("v", F.lit(2)))
    assert rows(identity.labeler_endpoints(handles, twice, order=F.col("v"))) == [("h1", "d1", "https://new.example")]
    repos = spark.createDataFrame([("p", "a")], "pds string, did string")
    errors = spark.createDataFrame([("a", "InvalidRequest")], "did string, message string")
    current = spark.createDataFrame([("a", "q"), ("a", "r"), ("a", None)], "did string, current_pds string")
    assert rows(identity.pds_fallback(repos, errors, current)) == [("a", "r")]
    dated = spark.createDataFrame([("a", "z", 1), ("a", "b", 2)], "did string, current_pds string, day int")
    assert rows(identity.pds_fallback(repos, errors, dated, order=F.col("day"))) == [("a", "b")]


def test_endpoints_to_read(spark):
    labels = spark.createDataFrame([("two.example", 7), ("two.example", 9)], "endpoint string, seq bigint")
    got = discovery.endpoints_to_read(views(spark), docs(spark), labels)
    assert rows(got) == [("two.example", 9)]
    assert rows(endpoints.resume_seq_by_endpoint(got, labels.limit(0))) == [("two.example", 0)]


def test_moved_accounts_are_asked_elsewhere(spark):
    repos = spark.createDataFrame([("p", d) for d in "abcd"], "pds string, did string")
    errors = spark.createDataFrame([("a", "InvalidRequest"), ("a", "x"), ("b", "RateLimitExceeded"),
                                    ("d", "InvalidRequest")], "did string, message string")
    current = spark.createDataFrame([("a", "q"), ("b", "q")], "did string, current_pds string")
    assert rows(identity.pds_fallback(repos, errors, current)) == [
        ("a", "q"), ("b", "p"), ("c", "p"), ("d", "p")]
