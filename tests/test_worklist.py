import json
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidelog import batches
from tidelog.functions import keys, messages
from tidelog.operators import sinks, worklist
from tidelog.plans import crawl
from tidelog.sources import files


def paths(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "path string")


def test_file_keys(spark):
    df = paths(spark, "/d/did-plc-a_profile.json", "/d/did-plc-a_follows.json.tmp", "/d/plain.json",
               "/d_x/did-plc-b_followers.json")
    k = keys.file_key(F.col("path"))
    assert rows(df.select(k["did"], k["kind"])) == [
        (None, None), (None, None), ("did-plc-a", "profile"), ("did-plc-b", "followers")]
    audit = paths(spark, "/a/did-plc-a_audit_log.json", "/a/did-plc-b_audit_log.json.tmp")
    assert rows(audit.select(keys.audit_key(F.col("path")))) == [(None,), ("did-plc-a",)]
    dated = paths(spark, "/x/2025-10-22.json", "/x/none.json")
    assert rows(dated.select(keys.date_from_path(F.col("path")))) == [("",), ("2025-10-22",)]


def test_completeness(spark):
    inventory = paths(spark, *[f"/d/did-{d}_{k}" for d, ks in {
        "a": ("profile.json", "follows.json", "followers.json", "extra.json"),
        "b": ("profile.json", "follows.json"),
        "c": ("profile.json", "follows.json", "followers.json.tmp")}.items() for k in ks])
    repos = spark.createDataFrame([("p", "did:a"), ("p", "did:b"), ("q", "did:c")], "pds string, did string")
    assert rows(crawl.profiles_to_fetch(repos, inventory)) == [("p", "did:b"), ("q", "did:c")]


def test_pending_and_done_partition_the_work(spark):
    work = spark.range(1000).select(F.concat(F.lit("did:"), F.col("id").cast("string")).alias("did"))
    work = work.unionByName(work.limit(10)).unionByName(
        spark.createDataFrame([(None,), ("",)], "did string"))
    inventory = spark.range(0, 1000, 3).select(F.concat(
        F.lit("/l/did-"), F.col("id").cast("string"), F.lit("_audit_log.json")).alias("path"))
    todo = {r[0] for r in worklist.pending_audit_dids(work, inventory).collect()}
    assert todo == {f"did:{i}" for i in range(1000) if i % 3}


def test_pending_repos_and_fallback(spark):
    repos = spark.createDataFrame([("p", "did:a"), ("p", "did:b"), ("q", "did:c")], "pds string, did string")
    inventory = paths(spark, "/r/did-a.txt", "/r/did-c.txt", "/r/did-b.txt.tmp")
    assert rows(worklist.pending_repos(repos, inventory)) == [("p", "did:b")]
    errors = spark.createDataFrame([("did:b", "InvalidRequest")], "did string, message string")
    current = spark.createDataFrame([("did:b", "new")], "did string, current_pds string")
    assert rows(crawl.repos_to_fetch(repos, inventory, errors, current)) == [("did:b", "new")]


def test_outcomes(spark):
    answers = [("a", 200, "[1]"), ("b", 200, "[]"), ("c", 200, " { } "), ("d", 500, "[1]"),
               ("e", 200, "{bad"), ("f", 200, ""), ("g", 200, None), ("h", None, "[1]"), ("i", 200, "null"),
               ("j", 500, "x"), ("j", 200, '{"a":[]}'), ("done", 200, "[1]")]
    dids = spark.createDataFrame([(x,) for x in "abcdefghijka"] + [("done",)], "did string")
    done = spark.createDataFrame([("done",)], "did string")
    results = worklist.fetch_results(dids, done, spark.createDataFrame(
        answers, "did string, http_status int, body string"))
    assert dict(tuple(r) for r in results.collect()) == {
        "a": "stored", "b": "empty", "c": "empty", "d": "failed", "e": "failed", "f": "failed",
        "g": "failed", "h": "failed", "i": "empty", "j": "stored", "k": "not_asked", "done": "done_before"}
    assert dict(tuple(r) for r in worklist.fetch_outcomes(results).collect())["failed"] == 5


def test_repo_lists_stay_small_for_a_huge_server(spark):
    repos = spark.range(20000).selectExpr("if(id < 15000, 'big', 'p' || id % 50) AS pds", "'did:' || id AS did")
    repos = repos.unionByName(repos.where("did = 'did:3'"))
    lists = worklist.repos_by_pds(repos, chunk_size=100).cache()
    assert lists.selectExpr("max(size(items))").first()[0] < 200
    assert lists.where("pds = 'big'").count() == 150
    flat = lists.selectExpr("pds", "inline(items)")
    assert flat.count() == 20000 and flat.agg(F.sum("copies")).first()[0] == 20001


def test_a_huge_server_is_dealt_out_again_after_the_join(spark):
    repos = spark.range(3000).selectExpr("if(id < 2000, 'big', if(id < 2100, null, 'p')) AS pds", "'did:' || id AS did")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lists = worklist.repos_by_pds(repos, chunk_size=100)
        plan = lists._jdf.queryExecution().executedPlan().toString()
        join = plan.index("Join")
        assert "hashpartitioning(pds" in plan[:join] and "chunk" in plan[:join]
        assert lists.where("pds is null").selectExpr("sum(size(items))").first()[0] == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_listing_ends(spark):
    pages = spark.createDataFrame([("a", 0, False), ("a", 1, True), ("b", 0, False), ("c", 1, True), ("d", 0, True), ("d", 0, True),
                                   ("e", 0, None)], "k string, page_no int, ended boolean")
    got = files.listing_complete(pages, "k", F.col("ended"))
    assert rows(got.select("k", "n_pages", "complete")) == [
        ("a", 2, True), ("b", 1, False), ("c", 1, False), ("d", 1, True), ("e", 1, False)]


def test_json_map_round_trip(spark, folder):
    repos = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "c")], "pds string, did string")
    sinks.json_map_lines(worklist.repos_by_pds(repos)).write.text(f"{folder}/m")
    back = files.json_map_scan(spark, f"{folder}/m", "array<struct<did: string>>")
    assert rows(back.selectExpr("key", "inline(value)")) == [("p", "a"), ("p", "b"), ("q", "c")]
    with open(f"{folder}/pretty.json", "w") as f:
        f.write('{\n  "h1": "d1",\n  "h2": "d2"\n}')
    pretty = files.json_map_scan(spark, f"{folder}/pretty.json", "string", whole_files=True)
    assert rows(pretty) == [("h1", "d1"), ("h2", "d2")]


@pytest.fixture
def tiny_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def nested(rnd, depth=0):
    kind = rnd.randrange(6 if depth < 3 else 3)
    if kind < 3:
        return rnd.choice(['x', 'a "b" {', '}],', '\\', 'é\n,', '', 7, None, True, '{"k": ['])
    if kind == 3:
        return [nested(rnd, depth + 1) for _ in range(rnd.randrange(4))]
    return {rnd.choice('kl"{,') + str(i): nested(rnd, depth + 1) for i in range(rnd.randrange(4))}


def test_objects_of_any_size_split_into_entries(spark, folder, tiny_splits):
    rnd, want = random.Random(1), {}
    for n in range(6):
        with open(f"{folder}/f{n}.json", "w") as f:
            for m in range(rnd.randrange(4)):
                one = {f"{n}-{m}-{i}": nested(rnd) for i in range(rnd.choice([0, 1, 40]))}
                want |= one
                f.write(json.dumps(one, indent=rnd.choice([None, 0, 1, 4]), ensure_ascii=rnd.random() < 0.5) + rnd.choice(["\n", "\n\n"]))
    with open(f"{folder}/odd.json", "w") as f:  # keys and values on lines of their own, entries sharing lines
        f.write('{ "o1":\n 1, "o2": {"a": [\n1]}, \t\n\n"o3"\n:\n[2,\n3]\r\n, "o4": "x"\n,"o5"  : 5}')
    want |= {"o1": 1, "o2": {"a": [1]}, "o3": [2, 3], "o4": "x", "o5": 5}
    entries = files.json_map_entries(spark, folder)
    assert {k: v for r in entries.collect() for k, v in json.loads(r.value).items()} == want
    assert spark.read.text(folder).rdd.getNumPartitions() > 20 and entries.count() > 40
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan


def test_an_inventory_is_kept_up(spark, folder):
    table = files.inventory_table(spark, f"{folder}/inventory")
    for n in range(3):
        os.makedirs(f"{folder}/in/d{n}")
        for m in range(4):
            with open(f"{folder}/in/d{n}/f{m}", "w") as f:
                f.write("x" * (n + m + 1))
        files.update_inventory(spark, f"{folder}/in", table, f"{folder}/cp", max_files=3)
        whole = files.file_inventory(spark, f"{folder}/in")
        assert rows(batches.read(table).select("path", "length", "modificationTime")) == rows(whole)
    # A run has rows for new files only.
    assert [r.rows for r in batches.ledger(table).groupBy("batch_id").agg({"rows": "sum"}).withColumnRenamed(
        "sum(rows)", "rows").orderBy("batch_id").collect()] == [3, 1] * 3
    files.update_inventory(spark, f"{folder}/in", table, f"{folder}/cp")
    assert batches.last_batch(table) == 5


def test_totals(spark):
    repos = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "c")], "pds string, did string")
    assert worklist.crawl_totals(repos).first()[:] == (2, 3)
    assert worklist.crawl_totals(repos.limit(0)).first()[:] == (0, 0)


def test_edges(spark):
    follows = spark.createDataFrame([(1, [2, 3, 3]), (4, [])], "did bigint, list array<bigint>")
    followers = spark.createDataFrame([(2, [1, 5]), (1, None)], "did bigint, list array<bigint>")
    assert rows(worklist.follow_edges(follows, followers)) == [(1, 2), (1, 3), (5, 2)]


def test_error_routes(spark):
    df = spark.createDataFrame([("InvalidRequest RateLimitExceeded",), ("RateLimitExceeded",), ("x",), (None,)],
                               "m string")
    assert [r[0] for r in df.select(messages.route_error(F.col("m"))).collect()] == [
        "moved", "rate_limited", "other", None]


def test_documents_are_replaced_whole(spark, folder):
    def docs(*data):
        return spark.createDataFrame(data, "key string, doc string, v int")
    path = f"{folder}/docs"
    sinks.keyed_json_sink(docs(*[(f"k{i}", "old", 1) for i in range(100)]), path, F.col("v"), buckets=8)
    sinks.keyed_json_sink(docs(("k1", "x", 1), ("k1", "new", 2), ("n", "new", 1)), path, F.col("v"), buckets=8)
    got = dict(tuple(r) for r in sinks.read_keyed(spark, path, 8).collect())
    assert len(got) == 101 and got["k1"] == got["n"] == "new" and got["k2"] == "old"
    assert sinks.read_keyed(spark, path, 8).count() == 101
    assert rows(sinks.read_keyed(spark, path, 8, docs(("k1", "", 0), ("none", "", 0)))) == [("k1", "new")]
    with pytest.raises(ValueError):
        sinks.keyed_json_sink(docs(("k1", "y", 3)), path, F.col("v"), buckets=16)
    for order in (1, -1):
        tie = docs(*[("t", "a", 1), ("t", "b", 1)][::order])
        sinks.keyed_json_sink(tie, f"{folder}/tie{order}", F.col("v"), buckets=2)
        assert sinks.read_keyed(spark, f"{folder}/tie{order}", 2).first().doc == "b"


def test_an_update_rewrites_nothing_and_counts_as_a_whole(spark, folder, monkeypatch):
    def docs(n, text):
        return spark.range(n).selectExpr("'k' || id AS key", f"'{text}' || id AS doc", "1 AS v")

    def modified():
        return {f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for d, _, names in os.walk(folder) for n in names if "part-" in n}
    sinks.keyed_json_sink(docs(200, "old"), folder, F.col("v"), buckets=4, due=3)
    before = modified()
    sinks.keyed_json_sink(docs(50, "new"), folder, F.col("v"), buckets=4, due=3)
    assert before.items() <= modified().items()
    wanted = {f"k{i}": f"{'new' if i < 50 else 'old'}{i}" for i in range(200)}
    assert dict(map(tuple, sinks.read_keyed(spark, folder, 4).collect())) == wanted
    # Dies with its files written: the old documents, all of them.
    with monkeypatch.context() as m:
        m.setattr(batches, "_summary", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.keyed_json_sink(docs(200, "lost"), folder, F.col("v"), buckets=4, due=3)
    assert dict(map(tuple, sinks.read_keyed(spark, folder, 4).collect())) == wanted
    assert sinks.keyed_json_sink(docs(1, "newest"), folder, F.col("v"), buckets=4, due=3) == 2
    wanted["k0"] = "newest0"
    table = sinks.keyed_table(spark, folder, 4)
    assert batches.state(table).upto == 2 and len(batches.state(table).sets) == 4
    assert dict(map(tuple, sinks.read_keyed(spark, folder, 4).collect())) == wanted


def test_ledger(spark, folder):
    def failed(*dids):
        return spark.createDataFrame([(x,) for x in dids], "did string")
    for _ in range(2):
        sinks.failure_ledger(failed("a", "b"), f"{folder}/log")
        sinks.failure_ledger(failed("a", "b"), f"{folder}/set")
    sinks.failure_ledger(failed("c"), f"{folder}/set")
    assert spark.read.parquet(f"{folder}/log").count() == 4
    assert rows(sinks.read_failures(spark, f"{folder}/set", "did string", as_set=True)) == [("a",), ("b",), ("c",)]
    assert sinks.read_failures(spark, f"{folder}/set", "did string").count() == 5


def test_csv_keeps_nulls_and_blanks(spark, folder):
    df = spark.createDataFrame([("h", "d", None), ("i", "e", " x, \"y\" ")], "handle string, did string, service_endpoint string")
    sinks.csv_sink(df, f"{folder}/c")
    assert rows(files.csv_endpoints(spark, f"{folder}/c")) == rows(df)
