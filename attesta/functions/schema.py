"""The nested record, its enums, and a JSON schema builder with vendor forms."""

from __future__ import annotations

from pyspark.sql import types as T

# The enums of the record.
AGE_FORMATS = ["mean_sd", "mean_only", "median", "range_only", "brackets", "mixed", "none"]
GENDER_FORMATS = ["pct", "counts", "pct_and_counts", "none"]
STUDY_TYPES = ["development", "validation", "both", "application"]
COVERAGE = ["full", "sample", "none"]
QUALITY = ["GOOD", "SCANNED", "POOR"]
CONFIDENCE = ["high", "medium", "low"]

# The record's fields, by which results of the models are read.
ITEM = "item_number string, subscale string, item_text_original string, item_text_english string, shared_stem string, reverse_scored boolean, source_page bigint"
SCALE = (
    "scale_name string, scale_abbreviation string, scale_citation string, which_sample string, scale_evidence_quote string, "
    "total_items_in_scale bigint, items_coverage string, response_format string, subscales string, items items, "
    "items_extracted_count bigint, scale_name_verified boolean"
)
SAMPLE = (
    "sample_label string, is_primary boolean, is_multi_population boolean, other_populations_note string, total_n bigint, "
    "population_type string, country_location string, age_mean double, age_sd double, age_range_min double, age_range_max double, "
    "age_notes string, age_format string, gender_pct_female double, gender_n_female bigint, gender_pct_male double, "
    "gender_n_male bigint, gender_pct_other double, gender_n_other bigint, gender_notes string, gender_format string"
)
PAPER = "title string, year bigint, language string, country_study string, study_type string"
PDF_QUALITY = "text_extractable boolean, has_questionnaire_content boolean, quality_flag string, quality_notes string"
META = (
    "extraction_confidence string, confidence_reason string, extraction_notes string, total_scales_found bigint, "
    "total_items_extracted bigint, needs_human_review boolean, overruled_summary string"
)


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def _struct(fields: str) -> T.StructType:
    """A struct from 'name type, ...'; no session is needed."""
    kinds = [f.split() for f in fields.split(", ")]
    return T.StructType([T.StructField(n, T.ArrayType(_struct(ITEM)) if k == "items" else _TYPES[k]) for n, k in kinds])


RECORD = T.StructType(
    [
        T.StructField("paper_id", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("pdf_quality", _struct(PDF_QUALITY)),
        T.StructField("paper", _struct(PAPER)),
        T.StructField("samples", T.ArrayType(_struct(SAMPLE))),
        T.StructField("scales", T.ArrayType(_struct(SCALE))),
        T.StructField("extraction_meta", _struct(META)),
        T.StructField("provenance", T.StringType()),
    ]
)

SAMPLE_COLUMNS = _struct(SAMPLE).names
SCALE_COLUMNS = [c for c in _struct(SCALE).names if c != "items"]
ITEM_COLUMNS = _struct(ITEM).names
PAPER_COLUMNS = _struct(PAPER).names
QUALITY_COLUMNS = _struct(PDF_QUALITY).names
META_COLUMNS = _struct(META).names[:5]
JUDGE_COLUMNS = _struct(META).names[5:]
FLAT_COLUMNS = ["paper_id", "filename", "provenance", "doi", "url", *PAPER_COLUMNS, *QUALITY_COLUMNS, *SAMPLE_COLUMNS, *SCALE_COLUMNS, *ITEM_COLUMNS, "item_both_coders", *META_COLUMNS, *JUDGE_COLUMNS]

_KINDS = {"string": "string", "long": "integer", "integer": "integer", "double": "number", "boolean": "boolean"}

#: What a judge answers: its scales are the coders' verified union, so the strict form has none.
JUDGE_RECORD = T.StructType([f for f in RECORD.fields if f.name in ("pdf_quality", "paper", "samples", "extraction_meta")])
#: What a coder answers.
CODER_RECORD = T.StructType([f for f in RECORD.fields if f.name in ("pdf_quality", "paper", "samples", "scales", "extraction_meta")])


def json_schema(kind: T.DataType, enums: dict[str, list[str]] | None = None, notes: dict[str, str] | None = None, nullable: bool = False, name: str = "") -> dict:
    """The JSON schema of a Spark type: every property required, no others; numbers may be null. notes:
    descriptions by field name. nullable: the form with a flag instead of a type or null, and without
    additionalProperties."""
    enums, notes = enums or {}, notes or {}
    note = {"description": notes[name]} if name in notes else {}
    if isinstance(kind, T.StructType):
        props = {f.name: json_schema(f.dataType, enums, notes, nullable, f.name) for f in kind.fields}
        return {"type": "object", "properties": props, "required": list(props)} | ({} if nullable else {"additionalProperties": False}) | note
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": json_schema(kind.elementType, enums, {k: v for k, v in notes.items() if k != name}, nullable, name)} | note
    if name in enums:
        return {"type": "string", "enum": enums[name]} | note
    one = _KINDS[kind.typeName()]
    if one not in ("integer", "number"):
        return {"type": one} | note
    return ({"type": one, "nullable": True} if nullable else {"type": [one, "null"]}) | note


def for_vendor(vendor: str, kind: T.DataType = CODER_RECORD, enums: dict[str, list[str]] | None = None, notes: dict[str, str] | None = None, strict: bool = True) -> dict:
    """The three request forms of a type: a strict wrapper, the nullable form, and a tool with its description,
    enforced (``strict``) or not: the record with its nested items is too large to be."""
    if vendor == "nullable":
        return json_schema(kind, enums, notes, nullable=True)
    schema = json_schema(kind, enums, notes)
    if vendor == "strict":
        return {"type": "json_schema", "json_schema": {"name": "record", "strict": True, "schema": schema}}
    if vendor == "tool":
        return {"name": "record", "description": "Gives the structured record of this paper.", "input_schema": schema} | ({"strict": True} if strict else {})
    raise ValueError(f"no form for {vendor}")
