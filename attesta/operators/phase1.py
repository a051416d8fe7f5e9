"""The first phase's nested result as flat rows of 47 columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns of the first phase's flat table, by the parts of the nested result.
META = ["title", "year", "language", "country_study", "study_type"]
POPULATION = [
    "total_sample_size", "population_type", "population_specific", "age_info", "gender_info", "country_location", "recruitment_source",
    "clinical_characteristics", "exclusion_criteria", "verbatim_sample_description", "population_confidence",
]
SCALE = ["scale_name", "scale_abbreviation", "scale_citation", "scale_purpose", "item_source", "total_items_in_scale", "items_extracted_count", "response_format", "subscales", "was_administered"]
ITEM = ["item_number", "subscale", "item_text_original", "item_text_english", "connection_type", "domain", "reverse_scored", "shared_stem", "extraction_confidence", "measures_social_connection", "item_notes"]
SUMMARY = ["total_scales_found", "total_items_extracted", "needs_review", "review_reason"]
COLUMNS = ["doi", "url", *META, "filename", "extraction_status", "quality_flags", "notes", *POPULATION, *SCALE, *ITEM, *SUMMARY]

ITEM_TYPE = "struct<" + ",".join(f"{c}:string" for c in ITEM if c != "item_notes") + ",notes:string>"
SCALE_TYPE = "struct<scale_name:string,scale_abbreviation:string,scale_citation:string,scale_purpose:string,item_source:string,total_items_in_scale:string,items_extracted:string,response_format:string,subscales:array<string>,items:array<" + ITEM_TYPE + ">>"
MENTIONED_TYPE = "struct<scale_name:string,scale_abbreviation:string,original_citation:string,num_items_reported:string,connection_type:string,reason_not_extracted:string,was_administered:boolean>"
RESULT = (
    "filename string, extraction_status string, article_metadata struct<" + ",".join(f"{c}:string" for c in META) + ">, population_info struct<" + ",".join(f"{c}:string" for c in POPULATION) + ">, "
    "extraction_summary struct<total_scales_found:bigint,total_items_extracted:bigint,overall_confidence:string,needs_review:boolean,review_reason:string>, "
    f"scales_extracted array<{SCALE_TYPE}>, scales_mentioned_not_extracted array<{MENTIONED_TYPE}>"
)


def rows(results: DataFrame) -> DataFrame:
    """One row per item; a scale without items, a failed paper and a paper without scales are
    one row each; scales that were administered but not extracted (unless said otherwise) follow, for
    papers with scales. All text columns, absent as '', but the counts and needs_review."""
    ok = F.col("extraction_status") == "success"
    s, i, x = F.col("__scale"), F.col("__item"), F.col("__extra")
    n = F.coalesce("extraction_summary.total_items_extracted", F.lit(0))
    unsure = (n == 0) | (F.lower(F.coalesce("extraction_summary.overall_confidence", F.lit(""))) == "low")
    some = F.coalesce(F.size("scales_extracted"), F.lit(0)) > 0
    base = results.withColumns({"__ok": F.coalesce(ok, F.lit(False)), "__some": some & F.coalesce(ok, F.lit(False))})
    said = F.coalesce("extraction_summary.needs_review", F.lit(False))
    scales = F.when(F.col("__some"), F.col("scales_extracted"))
    one = base.withColumn("__scale", F.explode_outer(scales)).withColumn("__item", F.explode_outer("__scale.items"))
    review = ~F.col("__ok") | ~F.col("__some") | unsure | said | i.isNull()
    cols = {c: s[c] for c in SCALE if c not in ("items_extracted_count", "subscales", "was_administered")}
    cols |= {"items_extracted_count": s["items_extracted"], "subscales": F.array_join(s["subscales"], "; ")}
    cols |= {c: i[c] for c in ITEM if c != "item_notes"} | {"item_notes": i["notes"]}
    main = _flat(one, cols, review, F.col("extraction_summary.review_reason"))
    kept = F.filter("scales_mentioned_not_extracted", lambda m: F.coalesce(m["was_administered"], F.lit(True)))
    more = base.where("__some").withColumn("__extra", F.explode(kept))
    cols = {"scale_name": x["scale_name"], "scale_abbreviation": x["scale_abbreviation"], "scale_citation": x["original_citation"], "total_items_in_scale": x["num_items_reported"], "connection_type": x["connection_type"], "item_source": x["reason_not_extracted"], "was_administered": F.lit("True")}
    return main.unionByName(_flat(more, cols, F.lit(True), x["reason_not_extracted"]))


def _flat(df: DataFrame, cols: dict[str, Column], review: Column, reason: Column) -> DataFrame:
    cols = {c: F.col(f"article_metadata.{c}") for c in META} | {c: F.col(f"population_info.{c}") for c in POPULATION} | {"filename": F.col("filename"), "extraction_status": F.col("extraction_status")} | cols
    out = []
    for c in COLUMNS:
        if c in ("total_scales_found", "total_items_extracted"):
            out.append(F.coalesce(f"extraction_summary.{c}", F.lit(0)).cast("long").alias(c))
        elif c == "needs_review":
            out.append(review.alias(c))
        else:
            value = reason if c == "review_reason" else cols.get(c, F.lit(""))
            out.append(F.coalesce(value.cast("string"), F.lit("")).alias(c))
    return df.select(*out)
