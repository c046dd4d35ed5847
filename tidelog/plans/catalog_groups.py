"""Catalog: aggregates, windows, order, health, archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import archive, counts, endpoints, health, identity, worklist
from tidelog.plans.registry import SQL_TIME, query, text_day, text_time
from tidelog.session import workspace
from tidelog.sources import days, files, operations
from tidelog.sources import testdata as T
from tidelog.sources.testdata import with_sql

ACTIONS = list(counts.ACTIONS)


@query("type_action_counts", with_sql(
    """SELECT type, count(*) FILTER (WHERE action = 'create') AS "create",
       count(*) FILTER (WHERE action = 'delete') AS "delete",
       count(*) FILTER (WHERE action = 'update') AS "update" FROM v_ops GROUP BY type""", "v_ops"))
def type_action_counts(spark: SparkSession, d: str) -> DataFrame:
    return counts.type_action_counts(counts.counts_long(T.ops(spark, d)))


@query("type_action_counts_configured", with_sql(
    """SELECT type, count(*) FILTER (WHERE action = 'create' AND seq % 50 <> 7) AS "create",
       count(*) FILTER (WHERE action = 'delete' AND seq % 50 <> 7) AS "delete",
       count(*) FILTER (WHERE action = 'update' AND seq % 50 <> 7) AS "update",
       count(*) FILTER (WHERE seq % 50 = 7) AS other FROM v_ops GROUP BY type""", "v_ops"))
def type_action_counts_configured(spark: SparkSession, d: str) -> DataFrame:
    """With the actions given, as a stream needs it; an action that nobody gave is counted with the rest."""
    return counts.counts_for_actions(_with_purges(spark, d), ACTIONS)


def _with_purges(spark: SparkSession, d: str) -> DataFrame:
    return T.ops(spark, d).select("type", F.expr("if(seq % 50 = 7, 'purge', action) AS action"))


@query("type_action_counts_any", with_sql(
    """SELECT type, count(*) FILTER (WHERE action = 'create' AND seq % 50 <> 7) AS "create",
       count(*) FILTER (WHERE action = 'delete' AND seq % 50 <> 7) AS "delete",
       count(*) FILTER (WHERE seq % 50 = 7) AS purge,
       count(*) FILTER (WHERE action = 'update' AND seq % 50 <> 7) AS "update" FROM v_ops GROUP BY type""", "v_ops"))
def type_action_counts_any(spark: SparkSession, d: str) -> DataFrame:
    """A column for every action that occurs, also one that nobody knew of."""
    return counts.type_action_counts(counts.counts_long(_with_purges(spark, d)))


@query("counts_long", with_sql(
    "SELECT type, action, count(*) AS n FROM v_ops GROUP BY ALL", "v_ops"))
def counts_long(spark: SparkSession, d: str) -> DataFrame:
    return counts.counts_long(T.ops(spark, d))


@query("type_action_counts_other", with_sql(
    """SELECT type, count(*) FILTER (WHERE action = 'create') AS "create",
       count(*) FILTER (WHERE action <> 'create') AS other FROM v_ops GROUP BY type""", "v_ops"))
def type_action_counts_other(spark: SparkSession, d: str) -> DataFrame:
    """Actions that nobody listed are counted together."""
    return counts.type_action_counts(counts.counts_long(T.ops(spark, d)), ["create"], other="other")


@query("distinct_actions", with_sql("SELECT DISTINCT action FROM v_ops", "v_ops"))
def distinct_actions(spark: SparkSession, d: str) -> DataFrame:
    return counts.distinct_actions(T.ops(spark, d))


@query("labeler_dids", with_sql(
    "SELECT DISTINCT did FROM v_plc WHERE contains(pds, 'old')", "v_ops", "v_plc"))
def labeler_dids(spark: SparkSession, d: str) -> DataFrame:
    return identity.labeler_dids(T.plc_lines(spark, d).select("value"), marker="old")


@query("distinct_pds", with_sql("SELECT DISTINCT pds FROM v_plc", "v_ops", "v_plc"))
def distinct_pds(spark: SparkSession, d: str) -> DataFrame:
    return identity.distinct_pds(identity.parse_operations(T.plc_lines(spark, d)))


CHUNK = 50


@query("repos_by_pds", with_sql(
    f"""SELECT r.pds, ('0x' || substr(md5(r.did), 1, 8))::BIGINT % s.pieces AS chunk,
        count(*) AS n_repos, string_agg(r.did, ',' ORDER BY r.did) AS dids
        FROM (SELECT DISTINCT pds, did FROM v_repos) r
        JOIN (SELECT pds, CAST(ceil(count(DISTINCT did) / {CHUNK}.0) AS BIGINT) AS pieces
              FROM v_repos GROUP BY pds) s ON s.pds = r.pds
        GROUP BY ALL""", "v_repos"))
def repos_by_pds(spark: SparkSession, d: str) -> DataFrame:
    lists = worklist.repos_by_pds(T.repos(spark, d), CHUNK)
    return lists.select("pds", "chunk", F.size("items").cast("bigint").alias("n_repos"),
                        F.array_join("items.did", ",").alias("dids"))


@query("crawl_totals", with_sql(
    "SELECT count(DISTINCT pds) AS n_pds, count(*) AS n_repos FROM v_repos", "v_repos"))
def crawl_totals(spark: SparkSession, d: str) -> DataFrame:
    return worklist.crawl_totals(T.repos(spark, d))


@query("crawl_totals_by_pds", with_sql(
    "SELECT pds, count(*) AS n_repos FROM v_repos GROUP BY pds", "v_repos"))
def crawl_totals_by_pds(spark: SparkSession, d: str) -> DataFrame:
    return worklist.crawl_counts(T.repos(spark, d))


@query("handle_did_map", with_sql("SELECT handle, did FROM v_handles", "v_views", "v_handles"))
def handle_did_map(spark: SparkSession, d: str) -> DataFrame:
    return identity.handle_did_map(identity.explode_views(T.view_docs(spark, d)))


@query("duplicate_endpoints", with_sql(
    "SELECT endpoint, count(*) AS n FROM v_endpoints GROUP BY endpoint HAVING count(*) > 1",
    "v_urls", "v_norm", "v_endpoints"))
def duplicate_endpoints(spark: SparkSession, d: str) -> DataFrame:
    return endpoints.duplicate_endpoints(endpoints.clean_endpoints(T.urls(spark, d)))


OPS = ("seq bigint, commit_time timestamp, collected_at timestamp, action string, type string, author string, "
       "collect_date date")


def _newest(spark: SparkSession, d: str) -> DataFrame:
    """The newest day of the ops, stored by day."""
    path = workspace(spark, "ops-by-day")
    columns = [c.split()[0] for c in OPS.split(", ")]
    (T.ops(spark, d).select(*columns).hint("rebalance", F.col("collect_date"))
     .write.partitionBy("collect_date").parquet(path))
    return days.newest_day(spark, path, OPS)


@query("resume_seq", with_sql(
    "SELECT max(seq) AS seq FROM v_ops WHERE collect_date = (SELECT max(collect_date) FROM v_ops)",
    "v_ops"))
def resume_seq(spark: SparkSession, d: str) -> DataFrame:
    return health.resume_seq(_newest(spark, d))


@query("resume_seq_by_endpoint", with_sql(
    """SELECT e.endpoint, coalesce(max(l.seq), 0) AS seq FROM (
         SELECT DISTINCT endpoint FROM v_labels_stream UNION ALL SELECT 'https://silent.example') e
       LEFT JOIN v_labels_stream l ON l.endpoint = e.endpoint AND l.kind = 'labels'
       GROUP BY e.endpoint""", "v_labels_stream"))
def resume_seq_by_endpoint(spark: SparkSession, d: str) -> DataFrame:
    frames = T.label_frames(spark, d)
    known = frames.select("endpoint").distinct().unionByName(
        spark.createDataFrame([("https://silent.example",)], "endpoint string"))
    return endpoints.resume_seq_by_endpoint(known, endpoints.keep_label_frames(frames))


@query("resume_created_at", with_sql("SELECT max(created_at) AS created_at FROM v_plc", "v_ops", "v_plc"))
def resume_created_at(spark: SparkSession, d: str) -> DataFrame:
    return operations.resume_created_at(identity.parse_operations(T.plc_lines(spark, d)))


@query("fetch_outcomes", """
    SELECT CASE WHEN l.doc_id IS NOT NULL THEN 'done_before' WHEN d.doc_id % 3 = 0 THEN 'failed'
        WHEN d.doc_id % 5 = 0 THEN 'empty' WHEN d.doc_id % 7 = 0 THEN 'failed' ELSE 'stored' END AS outcome,
        count(*) AS n FROM (SELECT DISTINCT doc_id FROM documents) d
    LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) l USING (doc_id) GROUP BY ALL""")
def fetch_outcomes(spark: SparkSession, d: str) -> DataFrame:
    documents = T.table(spark, d, "documents")
    answers = documents.selectExpr(
        "doc_id AS did", "if(doc_id % 3 = 0, 500, 200) AS http_status",
        """CASE WHEN doc_id % 5 = 0 THEN if(doc_id % 2 = 0, '[]', '{ }')
                WHEN doc_id % 7 = 0 THEN '{broken'
                ELSE '[{"did":' || doc_id || '}]' END AS body""")
    done = T.table(spark, d, "labels").where("quality = 1").selectExpr("doc_id AS did")
    return worklist.fetch_outcomes(worklist.fetch_results(
        documents.selectExpr("doc_id AS did"), done, answers))


@query("active_endpoints", with_sql(
    f"""SELECT b.batch, strftime(time_bucket(INTERVAL 1 SECOND, l.ts), '{SQL_TIME}') AS window_start,
        count(DISTINCT l.endpoint) AS n FROM v_labels_stream l
        JOIN (SELECT endpoint, (row_number() OVER (ORDER BY endpoint) - 1) // 2 AS batch
              FROM (SELECT DISTINCT endpoint FROM v_labels_stream)) b ON b.endpoint = l.endpoint
        GROUP BY ALL""", "v_labels_stream"))
def active_endpoints(spark: SparkSession, d: str) -> DataFrame:
    frames = T.label_frames(spark, d)
    batches = endpoints.batch_assign(frames, size=2)
    return endpoints.active_endpoints(frames, batches).select(
        "batch", text_time("window_start").alias("window_start"), "n")


def _fingerprints(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Source days, and two copies; copy b lacks a line on every seventh day."""
    rows = T.raw_lines(spark, d).withColumnRenamed("collect_date", "day")
    firsts = rows.groupBy("day").agg(F.min("seq").alias("first_seq"))
    damaged = rows.join(firsts, "day").where("dayofmonth(day) % 7 <> 0 or seq <> first_seq")
    copies = rows.withColumn("root", F.lit("a")).unionByName(
        damaged.drop("first_seq").withColumn("root", F.lit("b")))
    return archive.fingerprint(rows, "day"), archive.fingerprint(copies, "root", "day")


VERIFIED = """SELECT collect_date AS day, root, root = 'a' OR
    CAST(substr(collect_date, 9, 2) AS INTEGER) % 7 <> 0 AS ok
    FROM (SELECT DISTINCT collect_date FROM v_ops), (VALUES ('a'), ('b')) r(root)"""


@query("backup_verify", with_sql(VERIFIED, "v_ops"))
def backup_verify(spark: SparkSession, d: str) -> DataFrame:
    verified = archive.backup_verify(*_fingerprints(spark, d), ["a", "b"])
    return verified.select(text_day("day").alias("day"), "root", "ok")


@query("retention_gate", with_sql(
    f"SELECT day, bool_and(ok) AS safe FROM ({VERIFIED}) GROUP BY day", "v_ops"))
def retention_gate(spark: SparkSession, d: str) -> DataFrame:
    verified = archive.backup_verify(*_fingerprints(spark, d), ["a", "b"])
    return archive.retention_gate(verified).select(text_day("day").alias("day"), "safe")


@query("batch_assign", with_sql(
    """SELECT endpoint, (row_number() OVER (ORDER BY endpoint) - 1) // 10 AS batch
       FROM (SELECT DISTINCT endpoint FROM v_endpoints)""", "v_urls", "v_norm", "v_endpoints"))
def batch_assign(spark: SparkSession, d: str) -> DataFrame:
    return endpoints.batch_assign(endpoints.clean_endpoints(T.urls(spark, d)))


@query("sorted_endpoints", with_sql(
    "SELECT DISTINCT endpoint FROM v_endpoints ORDER BY endpoint", "v_urls", "v_norm", "v_endpoints"))
def sorted_endpoints(spark: SparkSession, d: str) -> DataFrame:
    return endpoints.sorted_endpoints(endpoints.clean_endpoints(T.urls(spark, d)))


@query("stall_gaps", with_sql(
    f"""SELECT source, strftime(before, '{SQL_TIME}') AS "from", strftime(commit_time, '{SQL_TIME}') AS "to"
        FROM (SELECT type AS source, commit_time,
                lag(commit_time) OVER (PARTITION BY type ORDER BY seq) AS before FROM v_ops)
        WHERE commit_time - before >= INTERVAL 20 MINUTE""", "v_ops"))
def stall_gaps(spark: SparkSession, d: str) -> DataFrame:
    return health.stall_gaps(T.ops(spark, d)).select(
        "source", text_time("from").alias("from"), text_time("to").alias("to"))


@query("stall_gaps_open", with_sql(
    f"""SELECT source, strftime(commit_time, '{SQL_TIME}') AS "from", strftime(after, '{SQL_TIME}') AS "to"
        FROM (SELECT type AS source, commit_time,
                lead(commit_time) OVER (PARTITION BY type ORDER BY seq) AS after FROM v_ops)
        WHERE coalesce(after, TIMESTAMP '2024-03-01') - commit_time >= INTERVAL 20 MINUTE""", "v_ops"))
def stall_gaps_open(spark: SparkSession, d: str) -> DataFrame:
    """Also the silences that still go on in March."""
    as_of = F.lit("2024-03-01 00:00:00").cast("timestamp")
    return health.stall_gaps(T.ops(spark, d), as_of=as_of).select(
        "source", text_time("from").alias("from"), text_time("to").alias("to"))


@query("sequence_gaps", with_sql(
    """SELECT before + 1 AS first_missing, seq - 1 AS last_missing
       FROM (SELECT seq, lag(seq) OVER (ORDER BY seq) AS before FROM v_ops WHERE action <> 'delete')
       WHERE seq - before > 1""", "v_ops"))
def sequence_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Missing numbers once deletions are taken out."""
    return health.sequence_gaps(T.ops(spark, d).where("action <> 'delete'"), width=1000)


@query("last_valid_event", with_sql(
    """SELECT seq, action, type, author FROM v_ops
       WHERE collect_date = (SELECT max(collect_date) FROM v_ops)
       ORDER BY seq DESC LIMIT 1""", "v_ops"))
def last_valid_event(spark: SparkSession, d: str) -> DataFrame:
    return health.last_valid_event(_newest(spark, d), "seq", "collect_date", "action", "type",
                                   "author").select("seq", "action", "type", "author")


@query("lag_monitor", with_sql(
    """SELECT lag_s, lag_s // 3600 AS lag_h, CASE WHEN lag_s // 3600 > 1 THEN 'alert' ELSE 'ok' END AS status
       FROM v_ops WHERE collect_date = (SELECT max(collect_date) FROM v_ops)
       ORDER BY seq DESC LIMIT 1""", "v_ops"))
def lag_monitor(spark: SparkSession, d: str) -> DataFrame:
    return health.lag_monitor(_newest(spark, d))


@query("latest_file", with_sql(
    """SELECT '/landed/' || collect_date || '/' || seq || '.json' AS path FROM v_ops
       ORDER BY collected_at DESC, path DESC LIMIT 1""", "v_ops"))
def latest_file(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.lit("/landed/"), text_day("collect_date"), F.lit("/"),
                    F.col("seq").cast("string"), F.lit(".json"))
    return files.latest_file(T.ops(spark, d).select(
        path.alias("path"), F.col("collected_at").alias("modificationTime")))
