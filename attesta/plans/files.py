"""Queries of sources and sinks: tables go out through a sink and come back through a reader."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.plans import textual
from attesta.plans.roles import table
from attesta.sources import readers, scratch, sinks
from attesta.streaming import incremental, indexed, jobs

QUERIES, ORACLE_SQL = {}, {}


def query(name, sql=None):
    return textual.query(name, sql, (QUERIES, ORACLE_SQL))


@query("csv_text", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(text, '') AS text, '' AS note, coalesce(CAST(n_chars AS VARCHAR), '') AS n_chars FROM documents""")
def _(spark, d):
    at = scratch.folder(spark)
    sinks.csv(table(spark, d, "documents"), at, ["doc_id", "text", "doc_id", "note", "n_chars"])
    return readers.csv_text(spark, at)


@query("csv_typed", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN '' ELSE o_orderpriority END AS priority FROM orders""")
def _(spark, d):
    at, status = scratch.folder(spark), F.col("o_orderstatus")
    price = F.when(status == "P", "NA").otherwise(F.col("o_totalprice").cast("string")).alias("price")
    priority = F.when(status == "P", "NA").when(status == "O", "").otherwise(F.col("o_orderpriority")).alias("priority")
    sinks.csv(table(spark, d, "orders").select("o_orderkey", price, priority), at, ["o_orderkey", "price", "priority"])
    return readers.csv_typed(spark, at, "o_orderkey bigint, price double, priority string")


@query("read_batches", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, NULL AS c_mktsegment, CAST(10 AS BIGINT) AS source_batch FROM customer WHERE c_nationkey < 12
UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, c_mktsegment, 2 FROM customer WHERE c_nationkey >= 12""")
def _(spark, d):
    at, c = scratch.folder(spark), table(spark, d, "customer")
    sinks.csv(c.where("c_nationkey < 12"), f"{at}/batch_10.csv", ["c_custkey", "c_name"])
    kept = c.where("c_nationkey >= 12").select(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    kept.write.parquet(f"{at}/batch2.parquet")
    return readers.batches(spark, [f"{at}/batch_10.csv", f"{at}/batch2.parquet"])


@query("json_per_key", "SELECT lang, doc_id, text FROM documents")
def _(spark, d):
    at = scratch.folder(spark)
    sinks.json_per_key(table(spark, d, "documents").select("lang", "doc_id", "text"), at, "lang")
    return spark.read.schema("doc_id bigint, text string, lang string").json(at)


@query("request_lines", "SELECT 'paper-' || doc_id AS key, text, source FROM documents")
def _(spark, d):
    at = scratch.folder(spark)
    sinks.requests(table(spark, d, "documents"), F.struct("text", "source"), at, "doc_id")
    r = F.from_json("value", "key string, request struct<text string, source string>")
    return spark.read.text(at).select(r.alias("r")).select("r.key", "r.request.text", "r.request.source")


@query("pdf_files", """
SELECT doc_id, doc_id % 3 = 0 AS is_pdf, CASE WHEN doc_id % 5 > 0 THEN n_chars ELSE -1 END AS pages,
  CASE WHEN doc_id % 7 = 0 THEN 'ERROR' WHEN length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) > 200 THEN 'READY' ELSE 'NOT_READABLE' END AS state FROM documents""")
def _(spark, d):
    id = F.col("doc_id")
    content = F.encode(F.concat(F.when(id % 3 == 0, "%PDF-1.7\n").otherwise("%PS-%PDF-"), "text"), "UTF-8")
    info = F.concat(F.lit("Title: Pages\nPages:"), F.when(id % 5 > 0, F.concat(F.lit("     "), "n_chars")).otherwise(" none"), F.lit("\nTagged: no"))
    layer = readers.text_layer(F.concat(F.lit("\n\t "), "text", F.lit(" \n" * 200)), id % 7 == 0)
    return table(spark, d, "documents").select("doc_id", readers.is_pdf(content).alias("is_pdf"), F.coalesce(readers.pages_of(info), F.lit(-1)).alias("pages"), layer.alias("state"))


@query("provider_results", """
SELECT 'a' AS provider, conv_id || '.' || turn AS paper_id, text || '!' AS text, turn AS in_tok, CAST(length(text) AS BIGINT) AS out_tok, turn % 2 = 1 AS truncated, false AS failed FROM conversations
UNION ALL SELECT 'b', conv_id || '.' || turn, CASE WHEN turn % 3 <> 0 THEN text END, turn, length(text), turn % 2 = 1, turn % 4 = 1 OR turn % 3 = 0 FROM conversations""")
def _(spark, d):
    c = table(spark, d, "conversations").withColumn("id", F.concat(F.lit("paper-"), "conv_id", F.lit("."), "turn"))
    turn, n = F.col("turn"), F.length("text").cast("long")
    parts = F.array(F.struct("text"), F.struct(F.lit("!").alias("text")))
    one = F.struct(F.struct(parts.alias("parts")).alias("content"), F.when(turn % 2 == 1, "MAX_TOKENS").otherwise("STOP").alias("finishReason"))
    use = F.struct(turn.alias("promptTokenCount"), n.alias("candidatesTokenCount"))
    a = F.struct(F.col("id").alias("key"), F.struct(F.array(one).alias("candidates"), use.alias("usageMetadata")).alias("response"))
    said = F.struct(F.struct(F.when(turn % 3 != 0, F.col("text")).alias("content")).alias("message"), F.when(turn % 2 == 1, "length").otherwise("stop").alias("finish_reason"))
    body = F.struct(F.array(said).alias("choices"), F.struct(turn.alias("prompt_tokens"), n.alias("completion_tokens")).alias("usage"))
    b = F.struct(F.col("id").alias("custom_id"), F.struct(F.when(turn % 4 == 1, 500).otherwise(200).alias("status_code"), body.alias("body")).alias("response"))
    parsed = lambda r, who: readers.provider_results(c.select(F.to_json(r).alias("value")), who).withColumn("provider", F.lit(who))
    return parsed(a, "a").unionByName(parsed(b, "b"))


@query("paper_list", "SELECT page_id, url AS filepath FROM pages")
def _(spark, d):
    return readers.paper_list(table(spark, d, "pages").select("page_id", F.col("url").alias("filepath")))


@query("rebuild_auto", """
SELECT o_orderkey AS paper_id, 'auto' AS origin FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, 'judge' FROM orders WHERE o_orderstatus = 'P'""")
def _(spark, d):
    at, o = scratch.folder(spark), table(spark, d, "orders").withColumn("paper_id", F.col("o_orderkey"))
    locked = o.where("o_orderstatus = 'P'").select("paper_id", F.lit("judge").alias("origin"))
    for _ in range(2):  # the second time wipes what the first has written
        sinks.rebuild(o.select("paper_id", F.lit("auto").alias("origin")), at, locked)
    sinks.append(locked, at)
    return spark.read.schema("paper_id bigint, origin string").parquet(at)


@query("append_stream", """
SELECT o_orderkey AS paper_id, CASE WHEN o_orderstatus = 'P' THEN 'old' ELSE 'new' END AS origin FROM orders""")
def _(spark, d):
    at, o = scratch.folder(spark), table(spark, d, "orders").withColumn("paper_id", F.col("o_orderkey"))
    o.where("o_orderstatus = 'P'").select("paper_id", F.lit("old").alias("origin")).write.parquet(f"{at}/table")
    arrived = o.select("paper_id", F.lit("new").alias("origin"))
    for _ in range(2):  # what arrives again is there already
        arrived.write.mode("append").parquet(f"{at}/in")
        incremental.append_stream(spark, f"{at}/in", arrived.schema, f"{at}/table", f"{at}/state").awaitTermination()
    return spark.read.schema(arrived.schema).parquet(f"{at}/table")


@query("job_states", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'running' WHEN '2-HIGH' THEN 'done' WHEN '3-MEDIUM' THEN 'none' ELSE 'failed' END AS state FROM orders""")
def _(spark, d):
    p = F.col("o_orderpriority")
    status = F.when(p == "1-URGENT", "in_progress").when(p == "2-HIGH", "JOB_STATE_SUCCEEDED").when(p != "3-MEDIUM", "expired")
    return table(spark, d, "orders").select("o_orderkey", incremental.job_state(status).alias("state"))


@query("answered", """
SELECT conv_id || '.' || turn AS paper_id, CASE WHEN length(text) % 7 <> 0 THEN CAST(length(text) AS VARCHAR) END AS text, CASE WHEN length(text) % 7 = 0 THEN 'sevens' END AS error FROM conversations""")
def _(spark, d):
    def provider(prompt: str) -> str:
        if len(prompt) % 7 == 0:
            raise RuntimeError("sevens")
        return str(len(prompt))

    c = table(spark, d, "conversations")
    return incremental.answered(c.select(F.concat("conv_id", F.lit("."), "turn").alias("paper_id"), F.col("text").alias("prompt")), provider)


@query("summary_text", """
SELECT 'Orders' || chr(10) || '======' || chr(10) || 'orders: ' || format('{:,}', count(*)) || chr(10) || 'open: ' || format('{:.3f}', sum(CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END) / count(*)) || chr(10) AS summary FROM orders""")
def _(spark, d):
    share = F.avg(F.when(F.col("o_orderstatus") == "O", 1.0).otherwise(0.0))
    metrics = table(spark, d, "orders").agg(F.count("*").alias("orders"), share.alias("open"))
    return spark.createDataFrame([(sinks.summary(metrics, "Orders"),)], "summary string")


# A customer's orders are the status events of one job, in the order of their numbers.
@query("job_outcomes", """
WITH e AS (SELECT o_custkey AS paper_id, o_orderkey AS seq, CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS done, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS failed FROM orders),
r AS (SELECT *, sum(failed) OVER w AS f, sum(done) OVER w AS n FROM e WINDOW w AS (PARTITION BY paper_id ORDER BY seq)),
o AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY seq) AS i FROM r WHERE n >= 1 OR f >= 2)
SELECT paper_id, CASE WHEN n >= 1 THEN 'done' ELSE 'given_up' END AS outcome, CAST(f AS INTEGER) AS attempts FROM o WHERE i = 1""")
def _(spark, d):
    own, at = spark.newSession(), scratch.folder(spark)
    own.conf.set(*jobs.STORE)
    p = F.col("o_orderpriority")
    status = F.when(p == "1-URGENT", "expired").when(p == "2-HIGH", "JOB_STATE_SUCCEEDED").otherwise("in_progress")
    orders = own.readStream.schema(table(spark, d, "orders").schema).parquet(f"{d}/orders.parquet*")
    events = orders.select(F.col("o_custkey").alias("paper_id"), F.col("o_orderkey").alias("seq"), status.alias("status"), F.col("o_orderdate").alias("at"))
    run = jobs.outcomes(events).writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema("paper_id long, outcome string, attempts int").parquet(f"{at}/out")


# Conversations as files, one each, in one folder: one listing finds them. They go there as tasks end, not one after another by the driver.
_TALKS = "SELECT conv_id, count(*) AS n, string_agg(text, chr(10) ORDER BY turn) AS talk, list(role ORDER BY turn) AS roles FROM conversations GROUP BY conv_id"


def _talks(spark, d):
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text", "role"))).alias("t"))
    return turns.select("conv_id", F.size("t").alias("n"), F.array_join(F.transform("t", lambda x: x["text"]), "\n").alias("talk"), F.transform("t", lambda x: x["role"]).alias("roles"))


def _as_files(df, at):
    """(value): a file for each row."""
    df.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(at)


@query("json_files", f"""
SELECT CASE WHEN n % 3 = 2 THEN n ELSE -1 END AS scales, count(*) AS files FROM ({_TALKS}) GROUP BY 1""")
def _(spark, d):
    at, talks = scratch.folder(spark), _talks(spark, d)
    record = F.to_json(F.struct(F.col("conv_id").cast("string").alias("paper_id"), F.transform("roles", lambda r: F.struct(r.alias("scale_name"))).alias("scales")))
    other = F.to_json(F.struct(F.col("conv_id").alias("paper_id")))  # JSON, but no record
    n = F.col("n") % 3
    value = F.when(n == 0, F.substring(record, F.lit(1), F.floor(F.length(record) / 2).cast("int"))).when(n == 1, other).otherwise(record)
    _as_files(talks.select(value.alias("value")), at)
    read = readers.json_documents(spark, at, T.StructType.fromDDL("paper_id string, scales array<struct<scale_name string>>"))
    return read.groupBy(F.coalesce(F.size("record.scales"), F.lit(-1)).cast("long").alias("scales")).agg(F.count("*").alias("files"))


@query("text_files", f"""
SELECT conv_id AS paper_id, CASE WHEN n = 3 THEN 0 ELSE length(CAST(conv_id AS VARCHAR)) + length(talk) + 2 END AS n_chars FROM ({_TALKS}) WHERE n <> 2 AND roles[1] <> 'system'""")
def _(spark, d):
    at, talks = scratch.folder(spark), _talks(spark, d)
    # a file has a name of its own, and the number of its paper in its first line
    _as_files(talks.where("n <> 3").select(F.concat(F.col("conv_id").cast("string"), F.lit("\n"), "talk")), at)
    named = spark.read.text(at, wholetext=True).select(F.substring_index("value", "\n", 1).cast("long").alias("conv_id"), F.regexp_replace("_metadata.file_name", r"\.[^.]+$", ".pdf").alias("filename"))
    log = talks.join(named, "conv_id", "left").select(F.col("conv_id").alias("paper_id"), F.coalesce("filename", F.lit("lost.pdf")).alias("filename"), F.when(F.col("n") == 2, "poor").otherwise("ok").alias("status"))
    chosen = talks.where(F.get("roles", F.lit(0)) != "system").select(F.col("conv_id").alias("paper_id"))
    return readers.paper_texts(spark, log, at, chosen).select("paper_id", F.length("text").cast("long").alias("n_chars"))


@query("binary_files", f"""
SELECT n > 4 AS is_pdf, count(*) AS files, CAST(sum(strlen(talk) + 1 + CASE WHEN n > 4 THEN 6 ELSE 0 END) AS BIGINT) AS n_bytes FROM ({_TALKS}) GROUP BY 1""")
def _(spark, d):
    at = scratch.folder(spark)
    value = F.concat(F.when(F.col("n") > 4, "%PDF-\n").otherwise(""), F.col("talk"))
    _as_files(_talks(spark, d).select(value.alias("value")), at)
    read = spark.read.format("binaryFile").load(at).select(readers.is_pdf(F.col("content")).alias("is_pdf"), "length")
    return read.groupBy("is_pdf").agg(F.count("*").alias("files"), F.sum("length").alias("n_bytes"))


@query("append_indexed", """
SELECT o_orderkey AS paper_id, CASE WHEN o_orderstatus = 'P' THEN 'old' ELSE 'new' END AS origin FROM orders""")
def _(spark, d):
    at, o = scratch.folder(spark), table(spark, d, "orders").withColumn("paper_id", F.col("o_orderkey"))
    arrived = o.select("paper_id", F.lit("new").alias("origin"))
    # what is there comes first, then all, twice
    for part in (o.where("o_orderstatus = 'P'").select("paper_id", F.lit("old").alias("origin")), arrived, arrived):
        part.write.mode("append").parquet(f"{at}/in")
        indexed.append_stream(spark, f"{at}/in", arrived.schema, f"{at}/table", f"{at}/state").awaitTermination()
    return indexed.read(spark, f"{at}/table", arrived.schema)
