"""The roles that the driver's tables play in the library's queries.

A document is a paper and its text the source; its lines are items. Two coders see the lines but
every fourth each, a different one, and each adds the first line of the next document, which its own
need not contain. Whole tables and whole texts are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.functions import schema as S
from attesta.functions import text as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text), dealt out by document before anything is made of the texts: joins by document need
    that exchange anyway, it is shared by all that read it, and a file of few row groups is no few tasks."""
    return table(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos, line)."""
    return texts(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


def coder(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """(doc_id, pos, line) as one coder gives them."""
    skip = {"a": 1, "b": 2}[which]
    own = lines(spark, sf_dir).where(F.col("pos") % 4 != skip)
    first = table(spark, sf_dir, "documents").select((F.col("doc_id") - 1).alias("doc_id"), F.substring_index("text", "\n", 1).alias("line"))
    held = table(spark, sf_dir, "documents").select("doc_id")
    made = first.join(held, "doc_id", "left_semi").select("doc_id", F.lit(1_000_000 + skip).alias("pos"), "line")
    return own.unionByName(made)


def coders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line, in_a, in_b): the lines of both coders and who gives them, in one pass."""
    own = lines(spark, sf_dir).select("doc_id", "line", (F.col("pos") % 4 != 1).alias("in_a"), (F.col("pos") % 4 != 2).alias("in_b"))
    made = table(spark, sf_dir, "documents").select((F.col("doc_id") - 1).alias("doc_id"), F.substring_index("text", "\n", 1).alias("line"), F.lit(True).alias("in_a"), F.lit(True).alias("in_b"))
    return own.unionByName(made)


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source_norm)."""
    return texts(spark, sf_dir).select("doc_id", T.evidence_norm("text").alias("source_norm"))


def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the rows of the first phase: a part's brand is a scale, an order's lines of it an
    occurrence, the part's name an item."""
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    met = li.join(part, li["l_partkey"] == part["p_partkey"])
    return met.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int")).alias("row_id"),
        F.col("p_brand").alias("scale_name"),
        F.concat_ws("|", "p_brand", "l_orderkey").alias("scale_occurrence_id"),
        F.when(F.col("l_linestatus") == "O", F.col("p_name")).when(F.col("l_returnflag") != "A", F.col("p_name")).alias("item_text_english"),
        F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "N", 0).alias("needs_review"),
        F.when(F.col("l_linenumber") < 7, "success").otherwise("failed").alias("extraction_status"),
        F.when(F.col("p_size") > 25, "YES").when(F.col("p_size") > 10, "NO").alias("measures_social_connection"),
        F.col("l_orderkey").alias("order_key"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as nested records, and source_norm. A role is a scale, its turns the items (a
    system role has none); user turns are samples, those that leave 2 by four are primary. The source
    is the turns but every third."""
    turns = table(spark, sf_dir, "conversations").withColumn("norm", T.evidence_norm("text"))
    null = lambda kind: F.lit(None).cast(kind)
    scale, sample = S.RECORD["scales"].dataType.elementType, S.RECORD["samples"].dataType.elementType
    item = scale["items"].dataType.elementType

    def struct(kind, **values):
        return F.struct(*[(values[f.name] if f.name in values else null(f.dataType)).cast(f.dataType).alias(f.name) for f in kind.fields])

    one = turns.groupBy("conv_id", "role").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    items = F.transform("t", lambda x: struct(item, item_number=x["turn"], item_text_original=x["text"], reverse_scored=x["turn"] % 2 == 1))
    items = F.when(F.col("role") == "system", F.array().cast(scale["items"].dataType)).otherwise(items)
    held = one.select("conv_id", struct(scale, scale_name=F.col("role"), scale_abbreviation=F.upper(F.substring("role", 1, 2)), items_coverage=F.lit("FULL"), items=items).alias("s"), F.when(F.col("role") == "user", F.transform("t", lambda x: struct(sample, sample_label=x["turn"], is_primary=x["turn"] % 4 == 2, total_n=F.length(x["text"]), age_format=F.lit("Mean_SD")))).alias("samples"))
    scales = held.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("s.scale_name").alias("k"), "s"))).alias("s"), F.first("samples", ignorenulls=True).alias("samples"))
    source = turns.where("turn % 3 <> 1").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.col("norm").alias("n")))), lambda x: x["n"]), " ").alias("source_norm"))
    kinds = S.RECORD
    return scales.join(source, "conv_id", "left").select(
        F.col("conv_id").cast("string").alias("paper_id"),
        F.concat(F.lit("x_10.1000@"), F.col("conv_id").cast("string"), F.lit(".pdf")).alias("filename"),
        struct(kinds["pdf_quality"].dataType, quality_flag=F.lit("good")).alias("pdf_quality"),
        struct(kinds["paper"].dataType, title=F.concat(F.lit("Conversation "), F.col("conv_id").cast("string")), study_type=F.lit("Both")).alias("paper"),
        F.coalesce("samples", F.array().cast(kinds["samples"].dataType)).alias("samples"),
        F.transform("s", lambda x: x["s"]).alias("scales"),
        struct(kinds["extraction_meta"].dataType, extraction_confidence=F.lit("HIGH")).alias("extraction_meta"),
        F.lit("auto_agreement").alias("provenance"),
        F.coalesce("source_norm", F.lit("")).alias("source_norm"),
    )
