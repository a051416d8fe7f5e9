"""Nested records: parsing, repair, verification, merging and flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions import schema as S
from attesta.functions import text as T


def parsed(docs: DataFrame, json: str = "value") -> DataFrame:
    """Records from text, as the column record; null where nothing can be read.

    The text is tried as it is, then repaired, then for its first array of items alone, which becomes a
    record of one scale."""
    text = F.col(json)
    required = lambda r: F.when(r["scales"].isNotNull(), r)
    whole = required(F.from_json(text, S.RECORD))
    mended = required(F.from_json(T.repaired_json(text), S.RECORD))
    items = F.from_json(F.regexp_extract(text, r'(?s)"items"\s*:\s*(\[.*?\])', 1), f"array<struct<{S.ITEM}>>")
    scale = F.array(_struct_of({"scale_name": F.lit("Extracted scale"), "items": items}, S.RECORD["scales"].dataType.elementType))
    salvaged = F.when(items.isNotNull(), _struct_of({"scales": scale}, S.RECORD))
    return docs.withColumn("record", F.coalesce(whole, mended, salvaged))


def _struct_of(values: dict[str, Column], kind) -> Column:
    """A struct of the type with the given fields, others null."""
    return F.struct(*[(values[f.name] if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields])


def _with(s: Column, kind, **changes: Column) -> Column:
    """The struct with some fields replaced."""
    return F.struct(*[(changes.get(f.name, s[f.name])).cast(f.dataType).alias(f.name) for f in kind.fields])


_ITEM = S.RECORD["scales"].dataType.elementType["items"].dataType.elementType
_SCALE = S.RECORD["scales"].dataType.elementType
_SAMPLE = S.RECORD["samples"].dataType.elementType
_META = S.RECORD["extraction_meta"].dataType
_QUALITY = S.RECORD["pdf_quality"].dataType
_PAPER = S.RECORD["paper"].dataType


def counted(records: DataFrame) -> DataFrame:
    """Items per scale, scales and items per record."""
    scales = F.transform("scales", lambda s: _with(s, _SCALE, items_extracted_count=F.coalesce(F.size(s["items"]), F.lit(0))))
    total = F.aggregate(scales, F.lit(0).cast("long"), lambda n, s: n + s["items_extracted_count"])
    meta = _with(F.col("extraction_meta"), _META, total_scales_found=F.size(scales), total_items_extracted=total)
    return records.withColumn("extraction_meta", meta).withColumn("scales", scales)


def invalid(records: DataFrame) -> DataFrame:
    """Records of the wrong shape, set aside with the reason instead of stopping the batch."""
    reason = F.when(F.col("scales").isNull(), "no scales array").when(F.col("samples").isNull(), "no samples array").when(F.exists("scales", lambda s: s["items"].isNull()), "a scale without an items array")
    return records.withColumn("reason", reason).where("reason is not null")


def canonicalised(records: DataFrame) -> DataFrame:
    """Enum fields brought to their listed spelling."""
    c = T.canonical
    samples = F.transform("samples", lambda s: _with(s, _SAMPLE, age_format=c(s["age_format"], S.AGE_FORMATS), gender_format=c(s["gender_format"], S.GENDER_FORMATS)))
    scales = F.transform("scales", lambda s: _with(s, _SCALE, items_coverage=c(s["items_coverage"], S.COVERAGE)))
    return records.withColumns({
        "samples": samples, "scales": scales,
        "paper": _with(F.col("paper"), _PAPER, study_type=c(F.col("paper.study_type"), S.STUDY_TYPES)),
        "pdf_quality": _with(F.col("pdf_quality"), _QUALITY, quality_flag=c(F.col("pdf_quality.quality_flag"), S.QUALITY)),
        "extraction_meta": _with(F.col("extraction_meta"), _META, extraction_confidence=c(F.col("extraction_meta.extraction_confidence"), S.CONFIDENCE)),
    })


def coerced(docs: DataFrame, json: str = "value") -> DataFrame:
    """A judge's answer whose sections have the wrong type. A bare string as extraction_meta
    becomes its notes; confidence is medium and review needed where nothing is said; other sections of
    the wrong type are empty. Sections are read one by one from a VARIANT."""
    v = F.try_parse_json(json)
    text = lambda path: F.to_json(F.try_variant_get(v, path, "variant"))
    meta = F.coalesce(F.from_json(text("$.extraction_meta"), _META), _struct_of({}, _META))
    notes = F.coalesce(F.try_variant_get(v, "$.extraction_meta", "string"), F.lit(""))
    bare = F.schema_of_variant(F.try_variant_get(v, "$.extraction_meta", "variant")) == "STRING"
    meta = _with(
        meta, _META,
        extraction_notes=F.when(bare, notes).otherwise(meta["extraction_notes"]),
        extraction_confidence=F.coalesce(meta["extraction_confidence"], F.lit("medium")),
        needs_human_review=F.coalesce(meta["needs_human_review"], F.lit(True)),
    )

    def array(name, kind):
        return F.coalesce(F.from_json(text(f"$.{name}"), kind), F.array().cast(kind))

    sections = {"extraction_meta": meta, "samples": array("samples", S.RECORD["samples"].dataType), "scales": array("scales", S.RECORD["scales"].dataType)}
    for name in ("paper", "pdf_quality"):
        sections[name] = F.coalesce(F.from_json(text(f"$.{name}"), S.RECORD[name].dataType), _struct_of({}, S.RECORD[name].dataType))
    return docs.withColumns(sections)


def restored(judged: DataFrame, coders: DataFrame) -> DataFrame:
    """Samples that the judge dropped come back from the coder that has more (coder A on a tie),
    and the record is marked for review with a note."""
    best = coders.groupBy("paper_id").agg(F.max_by("samples", F.struct(F.size("samples"), F.when(F.col("coder") == "A", 1).otherwise(0))).alias("__s"))
    met = judged.join(best, "paper_id", "left")
    lost = (F.coalesce(F.size("samples"), F.lit(0)) < 1) & (F.coalesce(F.size("__s"), F.lit(0)) > 0)
    note = F.concat_ws(" | ", F.nullif(F.col("extraction_meta.extraction_notes"), F.lit("")), F.lit("samples restored from coder"))
    meta = F.when(lost, _with(F.col("extraction_meta"), _META, needs_human_review=F.lit(True), extraction_notes=note)).otherwise(F.col("extraction_meta"))
    return met.withColumn("extraction_meta", meta).withColumn("samples", F.when(lost, F.col("__s")).otherwise(F.col("samples"))).drop("__s")


def _key(i: Column) -> Column:
    return T.item_key(i["item_text_original"], i["item_text_english"])


def _verified(items: Column, source: Column) -> Column:
    """E7 on an array: items printed in the source, each key once, in order. Keys are made once an item."""
    keyed = F.transform(items, lambda i: F.struct(_key(i).alias("k"), i.alias("i")))
    return F.transform(T.firsts(F.filter(keyed, lambda p: (p["k"] != "") & F.contains(source, p["k"]))), lambda p: p["i"])


def pruned(records: DataFrame, source: str = "source_norm") -> DataFrame:
    """Each scale keeps its verified items; count and coverage follow, and the scale says
    whether its quote, name or abbreviation is printed. Scales stay without items too."""
    src = F.col(source)

    def one(s: Column) -> Column:
        left = _verified(F.coalesce(s["items"], F.array().cast(_SCALE["items"].dataType)), src)
        names = F.array(*[T.evidence_norm(s[c]) for c in ("scale_evidence_quote", "scale_name", "scale_abbreviation")])
        seen = F.exists(names, lambda k: (F.length(k) >= 3) & F.contains(src, k))
        return _with(s, _SCALE, items=left, items_extracted_count=F.size(left), items_coverage=F.when(F.size(left) == 0, "none").otherwise(s["items_coverage"]), scale_name_verified=seen)

    return records.withColumn("scales", F.transform("scales", one))


def item_keys_of(records: DataFrame, name: str = "keys") -> DataFrame:
    """E5: the distinct keys of a record's items."""
    keys = F.array_distinct(F.flatten(F.transform("scales", lambda s: F.transform(s["items"], _key))))
    return records.withColumn(name, F.array_remove(keys, ""))


def automatic(a: DataFrame, b: DataFrame, scales: DataFrame) -> DataFrame:
    """Papers resolved by agreement: the coder's record with more scales (A on a tie), with the
    merged scales (paper_id, scales) and its provenance."""
    right = b.select("paper_id", F.struct(*[c for c in b.columns if c != "paper_id"]).alias("__b"))
    left = a.select("paper_id", F.struct(*[c for c in a.columns if c != "paper_id"]).alias("__a"))
    met = left.join(right, "paper_id").join(scales.withColumnRenamed("scales", "__scales"), "paper_id")
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    base = F.when(n(F.col("__b.scales")) > n(F.col("__a.scales")), F.col("__b")).otherwise(F.col("__a"))
    out = met.select("paper_id", base.alias("__r"), "__scales")
    return out.select("paper_id", *[F.col(f"__r.{c}") for c in a.columns if c not in ("paper_id", "scales", "provenance")], F.col("__scales").alias("scales"), F.lit("auto_agreement").alias("provenance"))


def by_priority(*ranked: DataFrame, key: str = "paper_id") -> DataFrame:
    """One row per key, from the first table that has it."""
    all_ = None
    for i, df in enumerate(ranked):
        one = df.withColumn("__priority", F.lit(i))
        all_ = one if all_ is None else all_.unionByName(one, allowMissingColumns=True)
    rank = F.row_number().over(Window.partitionBy(key).orderBy("__priority"))
    return all_.withColumn("__rank", rank).where("__rank = 1").drop("__rank", "__priority")


def primary(samples: Column) -> Column:
    """The first primary sample, else the first."""
    return F.coalesce(F.get(F.filter(samples, lambda s: F.coalesce(s["is_primary"], F.lit(False))), F.lit(0)), F.get(samples, F.lit(0)))


def scalars(records: DataFrame) -> DataFrame:
    """One row per record: what two coders are compared by, from the primary sample, and n_samples."""
    one = records.withColumn("__s", primary(F.col("samples")))
    of = {"study_type": "paper", "age_format": "__s", "gender_format": "__s", "quality_flag": "pdf_quality", "total_n": "__s", "age_mean": "__s", "age_sd": "__s", "gender_pct_female": "__s"}
    return one.select("paper_id", *[F.col(f"{where}.{c}").alias(c) for c, where in of.items()], F.coalesce(F.size("samples"), F.lit(0)).alias("n_samples"))


def unresolved(a: DataFrame, b: DataFrame, union: DataFrame) -> DataFrame:
    """Records of papers that nobody settled: coder A's, else B's, with the coders' verified union
    (paper_id, scales), a review flag, a note and the provenance that says so; enums as listed."""
    base = by_priority(a, b).drop("scales", "provenance").join(union.select("paper_id", "scales"), "paper_id", "left")
    notes = F.coalesce(F.col("extraction_meta.extraction_notes"), F.lit(""))
    note = F.btrim(F.concat(notes, F.lit(" | NOT adjudicated: exported from coder output.")), F.lit(" |"))
    meta = _with(F.coalesce("extraction_meta", F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in _META.fields])), _META, needs_human_review=F.lit(True), extraction_notes=note)
    out = base.withColumn("extraction_meta", meta).withColumn("provenance", F.lit("coder_only_unresolved"))
    out = out.withColumn("scales", F.coalesce("scales", F.array().cast(S.RECORD["scales"].dataType)))
    return canonicalised(out.select(*a.columns))


def with_filename(records: DataFrame, log: DataFrame) -> DataFrame:
    """The file name that the log (paper_id, filename) holds for the paper, else ''."""
    named = log.groupBy("paper_id").agg(F.max("filename").alias("__filename"))
    return records.join(named, "paper_id", "left").withColumn("filename", F.coalesce("__filename", F.lit(""))).drop("__filename")


def flattened(records: DataFrame, consensus: str | None = None) -> DataFrame:
    """One row per item; a scale without items and a paper without scales are one row each. The 61
    columns of the flat table. consensus: an array column of keys that both coders verified."""
    one = records.withColumn("__s", primary(F.col("samples"))).withColumn("__scale", F.explode_outer("scales")).withColumn("__item", F.explode_outer("__scale.items"))
    both = F.array_contains(F.col(consensus), _key(F.col("__item"))) if consensus else F.lit(False)
    cols = {
        "doi": T.doi("filename"), "url": T.doi_url("filename"),
        "item_both_coders": F.when(F.col("__item").isNotNull(), F.coalesce(both, F.lit(False))),
    }
    where = {c: f"paper.{c}" for c in S.PAPER_COLUMNS} | {c: f"pdf_quality.{c}" for c in S.QUALITY_COLUMNS} | {c: f"__s.{c}" for c in S.SAMPLE_COLUMNS} | {c: f"__scale.{c}" for c in S.SCALE_COLUMNS} | {c: f"__item.{c}" for c in S.ITEM_COLUMNS} | {c: f"extraction_meta.{c}" for c in [*S.META_COLUMNS, *S.JUDGE_COLUMNS]}
    return one.select(*[(cols[c] if c in cols else F.col(where.get(c, c))).alias(c) for c in S.FLAT_COLUMNS])


def samples_table(records: DataFrame) -> DataFrame:
    """Every sample; a paper without samples is one row."""
    one = records.withColumn("__s", F.explode_outer("samples"))
    return one.select("paper_id", "filename", "provenance", "paper.title", "paper.study_type", *[F.col(f"__s.{c}") for c in S.SAMPLE_COLUMNS])


def scales_table(records: DataFrame) -> DataFrame:
    """E3."""
    one = records.withColumn("__scale", F.explode("scales"))
    return one.select("paper_id", "filename", "provenance", "paper.title", *[F.col(f"__scale.{c}") for c in S.SCALE_COLUMNS])


def items_table(records: DataFrame, consensus: str | None = None) -> DataFrame:
    """E4."""
    one = records.withColumn("__scale", F.explode("scales")).withColumn("__item", F.explode("__scale.items"))
    both = F.array_contains(F.col(consensus), _key(F.col("__item"))) if consensus else F.lit(False)
    return one.select("paper_id", "filename", *[F.col(f"__scale.{c}") for c in ("scale_name", "scale_abbreviation", "which_sample")], *[F.col(f"__item.{c}") for c in S.ITEM_COLUMNS], F.coalesce(both, F.lit(False)).alias("item_both_coders"))


def settled(judged: DataFrame, union: DataFrame) -> DataFrame:
    """Where the judge's answer was cut off (truncated) or has no scales, the coders' verified union
    (paper_id, scales) takes their place, with a review flag and, if cut off, a note."""
    met = judged.join(union.withColumnRenamed("scales", "__union"), "paper_id", "left")
    cut = F.coalesce("truncated", F.lit(False))
    lost = cut | (F.coalesce(F.size("scales"), F.lit(0)) < 1)
    note = F.concat_ws(" | ", F.nullif(F.col("extraction_meta.extraction_notes"), F.lit("")), F.lit("judge cut off: items from the verified union"))
    notes = F.when(cut, note).otherwise(F.col("extraction_meta.extraction_notes"))
    meta = F.when(lost, _with(F.col("extraction_meta"), _META, needs_human_review=F.lit(True), extraction_notes=notes)).otherwise(F.col("extraction_meta"))
    out = met.withColumn("extraction_meta", meta).withColumn("scales", F.when(lost, F.col("__union")).otherwise(F.col("scales")))
    return out.withColumn("provenance", F.lit("adjudicated")).drop("__union")
