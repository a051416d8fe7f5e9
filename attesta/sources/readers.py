"""Sources: delimited text, spreadsheets, nested JSON, page text and provider results."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.functions import schema as S


_CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "maxCharsPerColumn": -1, "encoding": "UTF-8"}


def csv_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every field as text, blank ones as '', quotes doubled, lines in quotes, fields of any length."""
    return spark.read.csv(path, inferSchema=False, emptyValue="", **_CSV).na.fill("")


def csv_typed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A given schema, NA as null, blank text as '', other blank fields and what is not of its type as null."""
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    plain = T.StructType([T.StructField(f.name, T.StringType()) for f in kinds.fields])
    read = spark.read.csv(path, schema=plain, emptyValue="", **_CSV).na.fill("")

    def typed(f: T.StructField) -> Column:
        given = F.nullif(F.col(f"`{f.name}`"), F.lit("NA"))
        return (given if isinstance(f.dataType, T.StringType) else given.try_cast(f.dataType)).alias(f.name)

    return read.select(*[typed(f) for f in kinds.fields])


def table(spark: SparkSession, path: str, sheet_reader=None) -> DataFrame:
    """Parquet, CSV, or a spreadsheet's first sheet by header, all text.

    Spreadsheets need a reader (path -> pandas frame); without one pandas is asked for its own, which needs
    an engine that may not be installed. They are one file of bounded size, read on the driver."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if re.search(r"\.xls[xm]$", path):
        import pandas as pd

        frame = (sheet_reader or (lambda p: pd.read_excel(p, dtype=str)))(path)
        return spark.createDataFrame(frame.astype(object).where(frame.notna(), None), schema=T.StructType([T.StructField(str(c), T.StringType()) for c in frame.columns]))
    return csv_text(spark, path)


def batches(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files in the order of the digits in their names, each row with its source_batch, columns
    united by name. No file is an error."""
    if not paths:
        raise FileNotFoundError("no batch files")
    number = lambda p: int(re.sub(r"[^0-9]", "", p.rsplit("/", 1)[-1]) or 0)
    out = None
    for path in sorted(paths, key=number):
        one = table(spark, path).withColumn("source_batch", F.lit(number(path)).cast("long"))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def json_documents(spark: SparkSession, path: str, schema: T.StructType = S.RECORD, required: str = "scales") -> DataFrame:
    """One document per file; one that can't be read, or lacks the required child, is null."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("record"))
    return whole.withColumn("record", F.when(F.col(f"record.{required}").isNotNull(), F.col("record")))


def _stem(path: Column) -> Column:
    """The file's name without its last extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]+$", "")


def paper_texts(spark: SparkSession, log: DataFrame, path: str, subsample: DataFrame | None = None) -> DataFrame:
    """Texts of the log's ok papers, restricted to a subsample if there is one; a missing file
    gives ''. A paper's text has the name of the log's ``filename``, but for the last extension; a log without
    that column names them by paper_id."""
    ok = log.where("status = 'ok'")
    if subsample is not None:
        ok = ok.join(subsample.select("paper_id"), "paper_id", "left_semi")
    texts = spark.read.text(path, wholetext=True).select(_stem(F.col("_metadata.file_name")).alias("__stem"), F.col("value").alias("text"))
    ok = ok.withColumn("__stem", _stem(F.col("filename")) if "filename" in log.columns else F.col("paper_id"))
    return ok.join(texts, "__stem", "left").drop("__stem").withColumn("text", F.coalesce("text", F.lit("")))


def is_pdf(content: Column) -> Column:
    """S9."""
    return F.substring(content, 1, 5) == F.encode(F.lit("%PDF-"), "UTF-8")


def pages_of(info: Column) -> Column:
    """The page count that a PDF tool printed, null if none."""
    return F.regexp_extract(info, r"(?m)^Pages:\s+(\d+)", 1).try_cast("long")


def text_layer(text: Column, failed: Column) -> Column:
    """READY over 200 characters within outer white space, else NOT_READABLE, ERROR where extraction failed."""
    held = F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    return F.when(failed, "ERROR").when(F.length(held) > 200, "READY").otherwise("NOT_READABLE")


RESULT_A = "key string, response struct<candidates array<struct<content struct<parts array<struct<text string>>>, finishReason string>>, usageMetadata struct<promptTokenCount bigint, candidatesTokenCount bigint>>"
RESULT_B = "custom_id string, error string, response struct<status_code bigint, body struct<choices array<struct<message struct<content string, refusal string>, finish_reason string>>, usage struct<prompt_tokens bigint, completion_tokens bigint>>>"


def provider_results(lines: DataFrame, provider: str, prefix: str = "paper-") -> DataFrame:
    """Result lines of a batch provider -> (paper_id, text, in_tok, out_tok, truncated, failed)."""
    if provider == "a":
        r = F.from_json("value", RESULT_A)
        text = F.array_join(F.transform(F.get(r["response"]["candidates"], F.lit(0))["content"]["parts"], lambda p: p["text"]), "")
        stop = F.get(r["response"]["candidates"], F.lit(0))["finishReason"]
        cols = [r["key"], text, r["response"]["usageMetadata"]["promptTokenCount"], r["response"]["usageMetadata"]["candidatesTokenCount"], stop == "MAX_TOKENS", text.isNull()]
    else:
        r = F.from_json("value", RESULT_B)
        first = F.get(r["response"]["body"]["choices"], F.lit(0))
        text = first["message"]["content"]
        bad = r["error"].isNotNull() | (r["response"]["status_code"] != 200) | first["message"]["refusal"].isNotNull()
        cols = [r["custom_id"], text, r["response"]["body"]["usage"]["prompt_tokens"], r["response"]["body"]["usage"]["completion_tokens"], first["finish_reason"] == "length", F.coalesce(bad, F.lit(True)) | text.isNull()]
    names = ["paper_id", "text", "in_tok", "out_tok", "truncated", "failed"]
    out = lines.select(*[c.alias(n) for c, n in zip(cols, names, strict=True)])
    return out.withColumn("paper_id", F.regexp_replace("paper_id", f"^{re.escape(prefix)}", "")).na.fill({"truncated": False})


def paper_list(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Needs the column filepath."""
    require(df, ["filepath"])
    return df.limit(limit) if limit else df


def require(df: DataFrame, columns: list[str]) -> None:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"columns missing: {', '.join(missing)}")
