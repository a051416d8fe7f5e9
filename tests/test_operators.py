"""Small golden cases and properties of the library's operators."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from attesta.functions import agreement as A
from attesta.functions import schema as S
from attesta.functions import text as T
from attesta.operators import audit, cluster, dedup, evidence, packing, records, remap, routing
from attesta.sources import readers, sinks
from attesta.streaming import incremental


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, want",
    [("3.5 years old.", "5 years old"), ("I: am", "am"), ("a-\n b", "ab"), ("  *Straße*  ", "strasse"), ("“Hi” – x", '"hi" - x'), (None, ""), ("", ""), ("a | b", "a b")],
)
def test_evidence_norm(spark, text, want):
    assert one(spark, T.evidence_norm("t"), t=text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("Ｆull… ß", "full... ss"), ("satisﬁed oﬀer", "satisfied offer"), ("ΟΔΥΣΣΕΥΣ ὀδός", "οδυσσευσ ὀδόσ"), ("a\u2009b\u2028c\u0085d\x1fe", "a b c d e"),
        ("cafe\u0301", "café"), ("２０ km²", "20 km2"), ("١. نص", "نص"), ("Straße ÉCOLE Ещё 漢字", "strasse école ещё 漢字"), ("ſalt ĳ ŉ", "salt ij ʼn"),
    ],
)
def test_evidence_norm_beyond_ascii(spark, text, want):
    """Ligatures, full-width forms, final sigma, Unicode's spaces: as Python's NFKC and casefold have it."""
    assert one(spark, T.evidence_norm("t"), t=text) == want


def test_printed_with_a_ligature_is_found(spark):
    items = spark.createDataFrame([("p", "1. I am satisfied", 0), ("p", "I am sad", 1)], "paper string, item string, ord int")
    src = spark.createDataFrame([("p", "Items: I am satisﬁed; I am glad")], "paper string, text string").select("paper", T.evidence_norm("text").alias("source_norm"))
    got = evidence.verified_items(items.withColumn("key", T.evidence_norm("item")), src, "paper", "key", "ord")
    assert [r["ord"] for r in got.collect()] == [0]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from("aB éÉßſﬁＦςΣσ\u0301\u2009\u00a0\x1f\n.-İıŉ٣漢é"), max_size=12), min_size=20, max_size=20))
def test_norms_as_python_has_them(spark, texts):
    import re
    import unicodedata

    def evidence_form(s):
        s = unicodedata.normalize("NFKC", s).casefold().translate(str.maketrans(T.SMART, T.PLAIN))
        s = re.sub(r"[*_`~]", "", s).replace("|", " ")
        s = re.sub(r"^\s*[a-z]?\d*[-.\d]*\s*[.):]\s*", "", re.sub(r"-\s*\n\s*", "", s))
        return re.sub(r"\s+", " ", s).strip().rstrip(".").strip()

    def coding_form(s):
        return re.sub(r"\s+", " ", unicodedata.normalize("NFC", s)).strip().lower()

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select("t", T.evidence_norm("t").alias("e"), T.coding_norm("t").alias("c")).collect()]
    for t, e, c in got:
        assert e == evidence_form(t), repr(t)
        assert c == coding_form(t), repr(t)


def test_evidence_pairs_of_any_needle(spark):
    """Words' parts, ends and beginnings, and repeated texts, against plain containment; by both ways."""
    texts = ["the quick brown fox", "unquick brownish", "ab cd", "xab cdy z", "a  b", "", "fox", "the quick brown fox", " lead trail "]
    needles = ["quick", "quick brown", "k brown f", "ab cd", "b c", "o", "he quick brown fo", " ", "lead trail", "nothing here", "", "x", "  "]
    src = spark.createDataFrame(list(enumerate(texts)), "id int, s string")
    ask = spark.createDataFrame(list(enumerate(needles)), "n int, k string")
    want = sorted((i, n) for i, t in enumerate(texts) for n, k in enumerate(needles) if k and k in t)
    for most in (10**6, 0):
        got = evidence.evidence_pairs(ask, "k", src, "s", most_bytes=most)
        assert sorted((r["id"], r["n"]) for r in got.collect()) == want


def test_clusters_skip_empty_keys_and_compare_with_founders(spark):
    rows = [("p", 0, "", []), ("p", 1, "", []), ("p", 2, "k1", ["a", "b"]), ("p", 3, "k2", ["a", "b", "c"]), ("p", 4, "k2", ["z"]), ("p", 5, "k1", ["q"])]
    df = spark.createDataFrame(rows, "paper_id string, ord int, key string, tokens array<string>")
    got = {r["ord"]: r["cluster"] for r in cluster.clustered(df).collect()}
    # 3 joins 2 by its words, but k2 is no founder's key: 4 founds a cluster of its own
    assert got == {0: 0, 1: 1, 2: 2, 3: 2, 4: 3, 5: 2}


def test_settings_and_events(spark, tmp_path, monkeypatch):
    from attesta.sources import settings as cfg

    monkeypatch.setenv("ATTESTA_HELD", "mine")
    monkeypatch.delenv("ATTESTA_NEW", raising=False)
    (tmp_path / "env").write_text("# note\nATTESTA_HELD=other\nATTESTA_NEW = 'x=y'\n\nbad line\nATTESTA_NEW=later\r\n ATTESTA_SET = \"a b\" \nATTESTA_EMPTY=\n=none\n")
    spark.conf.set("spark.attesta.ATTESTA_SET", "session's")
    got = {r.name: (r.value, r.origin) for r in cfg.resolved(spark, str(tmp_path / "env")).collect()}
    spark.conf.unset("spark.attesta.ATTESTA_SET")
    assert got == {"ATTESTA_HELD": ("mine", "environment"), "ATTESTA_NEW": ("x=y", "file"), "ATTESTA_SET": ("session's", "session"), "ATTESTA_EMPTY": ("", "file")}
    assert cfg.resolved(spark, str(tmp_path / "none")).collect() == []
    cfg.events(str(tmp_path / "logs"), "export").info("done")
    assert "[export]  done" in (tmp_path / "logs" / "pipeline.log").read_text() and (tmp_path / "logs" / "export.log").exists()
    (tmp_path / "file").write_text("")
    cfg.events(str(tmp_path / "file"), "export").info("goes nowhere, raises nothing")


def test_ordinal_stays(spark):
    from attesta.operators.ordinal import ordinal

    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, None), (2, "b")], "a int, b string")
    assert sorted((r["n"], r["a"], r["b"]) for r in ordinal(df, ["a", "b"], "n", 1).collect()) == [(1, 1, "a"), (2, 2, None), (3, 2, "b"), (4, 3, "c")]
    assert ordinal(df.limit(0), ["a"], "n").count() == 0


def test_upsert_keeps_the_order(spark):
    old = spark.createDataFrame([("b", "old", 0), ("a", "old", 1)], "k string, v string, n long")
    new = spark.createDataFrame([("c", "x", 0), ("a", "y", 1), ("c", "z", 2)], "k string, v string, n long")
    got = sinks.upserted(old, new, "k", "n").orderBy("n").collect()
    assert [(r["k"], r["v"]) for r in got] == [("b", "old"), ("a", "y"), ("c", "z")]
    assert [r["k"] for r in sinks.upserted(old.limit(0), new, "k", "n").orderBy("n").collect()] == ["c", "a"]


def test_text_layer_and_pages(spark):
    assert one(spark, readers.pages_of(F.col("t")), t="Title: x\nPages:          12\n") == 12
    assert one(spark, readers.text_layer(F.col("t"), F.lit(False)), t="x" * 201) == "READY"
    assert one(spark, readers.text_layer(F.col("t"), F.lit(False)), t="\n\t\u3000" * 200 + "x ") == "NOT_READABLE"
    assert one(spark, readers.text_layer(F.col("t"), F.lit(True)), t="x" * 300) == "ERROR"
    assert one(spark, readers.is_pdf(F.encode(F.col("t"), "UTF-8")), t="%PDF-1.7") is True


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("p1", 'a "quoted", text\nof two lines', None), ("p2", "b", 2)], "paper_id string, t string, n int")
    sinks.csv(df, str(tmp_path / "csv"), ["paper_id", "t", "paper_id", "missing", "n"])
    back = {r["paper_id"]: r for r in readers.csv_text(spark, str(tmp_path / "csv")).collect()}
    assert back["p1"]["t"] == 'a "quoted", text\nof two lines' and list(back["p1"].asDict()) == ["paper_id", "t", "missing", "n"]
    sinks.requests(df, F.struct("t"), str(tmp_path / "req"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "req")).collect())[1] == '{"key":"paper-p2","request":{"t":"b"}}'
    sinks.json_per_key(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    sinks.rebuild(df, str(tmp_path / "auto"), df.where("paper_id = 'p1'"))
    sinks.append(df, str(tmp_path / "auto"))
    assert sorted(r["paper_id"] for r in spark.read.parquet(str(tmp_path / "auto")).collect()) == ["p1", "p2", "p2"]
    assert "rows: 2,000" in sinks.summary(spark.sql("select 2000L as rows, 0.5D as share"), "Totals")
    with pytest.raises(ValueError):
        sinks.spreadsheet(df, "x", most=1)
    seen = []
    sinks.spreadsheet(df, "x", writer=lambda f, p: seen.append((len(f), p)))
    assert seen == [(2, "x")]
    with pytest.raises(ValueError):
        readers.paper_list(df)


def test_match_tiers(spark):
    assert one(spark, T.match_norm("a"), a="We think_x000D_are fair") == one(spark, T.match_norm("a"), a="We think\nare fair")
    assert one(spark, T.match_norm("a"), a="to tell") != one(spark, T.match_norm("a"), a="totell")
    assert one(spark, T.match_aggressive("a"), a="to tell") == one(spark, T.match_aggressive("a"), a="totell")
    assert one(spark, T.match_aggressive("a"), a="Привет") == ""


def test_references(spark):
    text = "body\n## References\nsome\nAppendix A\nitems"
    assert one(spark, T.without_references("t"), t=text) == "body\nAppendix A\nitems"
    assert one(spark, T.without_references("t"), t="body\nReferences\nx") == "body\n"
    assert one(spark, T.without_references("t"), t="no list here") == "no list here"


def test_keys_prefer_opposite_texts(spark):
    df = spark.createDataFrame([("Hund", "dog")], "o string, e string")
    assert df.select(T.coding_key("e", "o").alias("a"), T.item_key("o", "e").alias("b")).first() == ("dog", "hund")


def test_number_and_int(spark):
    assert one(spark, T.number("t"), t="1,250") == 1250.0
    assert one(spark, T.number("t"), t="n/a") is None
    assert one(spark, T.safe_int(F.col("t")), t="x") == 0


def test_merged_list(spark):
    assert one(spark, T.merged_list(F.col("a"), F.col("b")), a="Trust; fear", b="FEAR;; joy") == "Trust; fear; joy"


def test_agreement_of_one_category(spark):
    df = spark.createDataFrame([("x", "x")] * 3, "a string, b string")
    r = A.categorical(df, "a", "b").first()
    assert r["kappa"] is None and r["pabak"] == 1.0 and r["band"] == "n/a"


def test_icc_of_constants(spark):
    df = spark.createDataFrame([(2.0, 2.0)] * 3, "a double, b double")
    assert df.agg(A.icc(F.col("a"), F.col("b"))).first()[0] == 1.0
    assert df.limit(1).agg(A.icc(F.col("a"), F.col("b"))).first()[0] is None
    assert df.agg(A.pearson(F.col("a"), F.col("b"))).first()[0] is None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.floats(-5, 5), st.floats(-5, 5)), min_size=2, max_size=8))
def test_icc_by_definition(spark, pairs):
    n = len(pairs)
    g = sum(map(sum, pairs)) / 2 / n
    mx, my = sum(p[0] for p in pairs) / n, sum(p[1] for p in pairs) / n
    msr = sum(2 * ((x + y) / 2 - g) ** 2 for x, y in pairs) / (n - 1)
    msc = n * ((mx - g) ** 2 + (my - g) ** 2)
    mse = sum((x - (x + y) / 2 - mx + g) ** 2 + (y - (x + y) / 2 - my + g) ** 2 for x, y in pairs) / (n - 1)
    below = msr + mse + 2 * (msc - mse) / n
    if abs(below) > 1e-6:
        got = spark.createDataFrame(pairs, "a double, b double").agg(A.icc(F.col("a"), F.col("b"))).first()[0]
        assert got == pytest.approx((msr - mse) / below, abs=1e-6)


def test_attested_needs_three_characters(spark):
    df = spark.createDataFrame([("the ab scale of trust", "ab", "Trust")], "s string, a string, n string")
    assert df.select(evidence.attested(F.col("s"), F.col("a"))).first()[0] is False
    assert df.select(evidence.attested(F.col("s"), F.col("a"), F.col("n"))).first()[0] is True


def test_evidence_pairs_both_ways(spark):
    needles = spark.createDataFrame([(1, "quick brown fox jumps"), (2, "wn fo"), (3, "")], "i int, k string")
    texts = spark.createDataFrame([(1, "the quick brown fox jumps over"), (2, "nothing")], "d int, s string")
    wanted = {(1, 1), (2, 1)}
    for few in (10, 1):
        got = evidence.evidence_pairs(needles, "k", texts, "s", few).select("i", "d").collect()
        assert {tuple(r) for r in got} == wanted


def test_scale_ties_and_generic_names(spark):
    df = spark.createDataFrame([("A", "o1"), ("A", "o2"), ("A", "o3"), ("A", "o3"), ("a ", "o4"), ("A", "o4"), ("Single items", "x"), ("Single items", "y"), ("Single items", "y")], "scale_name string, scale_occurrence_id string")
    kept = {r[0] for r in dedup.scale_occurrences(df).where("keep_scale").select("scale_occurrence_id").collect()}
    assert kept == {"o3", "o4", "x", "y"}
    assert {r[0] for r in dedup.scale_occurrences(df, ties=False).where("keep_scale").select("scale_occurrence_id").collect()} == {"o3", "x", "y"}


def test_step_one_is_not_a_complement(spark):
    df = spark.createDataFrame([(None, "success", "x"), (0, "success", "x"), (1, "success", "x")], "needs_review int, extraction_status string, item_text_english string")
    assert (dedup.usable(df).count(), dedup.unusable(df).count(), dedup.unaccounted(df).count()) == (1, 1, 1)


def test_already_coded_may_be_blank(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "row_id long, key string")
    coded = spark.createDataFrame([("a", "")], "key string, code string")
    got = {r["row_id"]: (r["disposition"], r["inherit_final_coding"], r["maps_to_row_id"]) for r in remap.disposition(items, coded).collect()}
    assert got == {1: ("already_coded", "", None), 2: ("new", None, None), 3: ("internal_dup", None, 2)}


def test_first_row_over_budget_is_taken(spark):
    df = spark.createDataFrame([(1, 500), (2, 1)], "i int, n int")
    assert [r[0] for r in packing.prefix_within(df, "n", ["i"], 100, 10).collect()] == [1]


ITEM = dict.fromkeys(S.ITEM_COLUMNS)
SCALE = dict.fromkeys([*S.SCALE_COLUMNS, "items"])


def record(**values):
    base = {f.name: None for f in S.RECORD.fields} | {"paper_id": "p", "samples": [], "scales": [], "extraction_meta": dict.fromkeys([*S.META_COLUMNS, *S.JUDGE_COLUMNS])}
    return base | values


def scale(name, texts):
    return SCALE | {"scale_name": name, "items": [ITEM | {"item_text_original": t} for t in texts]}


def test_emission_cases(spark):
    df = spark.createDataFrame([record(), record(paper_id="q", scales=[scale("s", []), scale("t", ["x", "y"])])], S.RECORD)
    flat = records.flattened(df)
    assert len(flat.columns) == 61
    assert {(r["paper_id"], r["n"]) for r in flat.groupBy("paper_id").agg(F.count("*").alias("n")).collect()} == {("p", 1), ("q", 3)}
    want = {r["paper_id"]: r["n_rows"] for r in audit.expected_rows(df).collect()}
    assert want == {"p": 1, "q": 3}


def test_prune_twice_is_prune_once(spark):
    df = spark.createDataFrame([record(scales=[scale("trust", ["I trust you.", "i trust you", "invented"])])], S.RECORD).withColumn("source_norm", F.lit("as printed: i trust you a lot"))
    once = records.pruned(df)
    assert [len(s["items"]) for s in once.first()["scales"]] == [1]
    assert once.select("scales").collect() == records.pruned(once).select("scales").collect()
    none = records.pruned(df.withColumn("source_norm", F.lit(""))).first()["scales"][0]
    assert (none["items_coverage"], none["items_extracted_count"], none["scale_name_verified"]) == ("none", 0, False)


def test_parsing_falls_back(spark):
    rows = [("a", '{"scales": [], "samples": []}'), ("b", '```json\n{"scales": [], "samples": [],}\n```'), ("c", 'oops "items": [{"item_number": "1"}] end'), ("d", "nothing")]
    got = {r["k"]: r["record"] for r in records.parsed(spark.createDataFrame(rows, "k string, value string")).collect()}
    assert got["a"]["scales"] == [] and got["b"]["scales"] == []
    assert got["c"]["scales"][0]["scale_name"] == "Extracted scale" and got["d"] is None


def test_bare_meta_is_a_note(spark):
    df = spark.createDataFrame([('{"extraction_meta": "unsure", "scales": "none"}',)], "value string")
    r = records.coerced(df).first()
    assert (r["extraction_meta"]["extraction_notes"], r["extraction_meta"]["needs_human_review"], r["extraction_meta"]["extraction_confidence"], r["scales"]) == ("unsure", True, "medium", [])


@pytest.mark.parametrize("b, disputes", [(40.5, []), (40.6, ["age_mean"]), (None, [])])
def test_tolerance(spark, b, disputes):
    fields = ["n_samples", *routing.CATEGORIES, *routing.TOLERANCES, "items", "scales"]
    kinds = "paper_id string, n_samples int, study_type string, quality_flag string, total_n double, age_mean double, age_sd double, gender_pct_female double, items array<string>, scales array<string>"
    row = lambda age: spark.createDataFrame([("p", 1, "both", "GOOD", 10.0, age, None, None, ["x"], ["s"])], kinds)
    got = routing.routed(row(40.0), row(b), fields[:-2]).first()
    assert got["disputes"] == disputes and got["route"] == ("dispute" if disputes else "agreement")


def test_cluster_by_shared_words(spark):
    df = spark.createDataFrame([("p", 1, "k1", ["social", "trust", "feeling"]), ("p", 2, "k2", ["trust", "social"]), ("p", 3, "k3", ["fear"]), ("p", 4, "k1", ["other"])], "paper_id string, ord int, key string, tokens array<string>")
    got = {r["ord"]: r["cluster"] for r in cluster.clustered(df).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 0}


def test_audit_finds_seeded_faults(spark):
    e = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, n int")
    a = spark.createDataFrame([("a", 1), ("b", 5), ("z", 1)], "k string, n int")
    assert {(r["k"], r["problem"]) for r in audit.reconcile(e, a, "k", ["n"]).collect()} == {("b", "count"), ("c", "missing"), ("z", "orphan")}
    assert audit.reconcile(e, e, "k", ["n"]).count() == 0


def test_append_twice_is_append_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1)], "paper_id string, n int").write.parquet(path)
    new = spark.createDataFrame([("a", 9), ("b", 2)], "paper_id string, n int")
    assert sinks.append_new(spark, new, path, "paper_id") == 1
    assert sinks.append_new(spark, new, path, "paper_id") == 0
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 1), ("b", 2)]


def test_stream_appends_what_arrives(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "paper_id string, n int")
    rows.limit(0).write.parquet(out)
    for _ in range(2):
        rows.write.mode("append").parquet(source)
        incremental.append_stream(spark, source, rows.schema, out, str(tmp_path / "cp")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [("a", 1), ("b", 2)]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([("1", 'say "hi",\nthere', None)], "id string, t string, e string")
    sinks.csv(df, path, ["id", "t", "e", "id", "absent"])
    got = readers.csv_text(spark, path)
    assert got.columns == ["id", "t", "e", "absent"] and tuple(got.first())[:2] == ("1", 'say "hi",\nthere')
    readers.require(got, ["id"])
    with pytest.raises(ValueError):
        readers.require(got, ["filepath"])


def test_csv_keeps_blanks_and_outer_white_space(spark, tmp_path):
    (tmp_path / "c.csv").write_text('id,t,n\n1,,\n2,"",NA\n3,NA,x\n4,"  two\n lines ",7\n')
    text = [tuple(r) for r in readers.csv_text(spark, str(tmp_path / "c.csv")).orderBy("id").collect()]
    assert text == [("1", "", ""), ("2", "", "NA"), ("3", "NA", "x"), ("4", "  two\n lines ", "7")]
    typed = [tuple(r) for r in readers.csv_typed(spark, str(tmp_path / "c.csv"), "id bigint, t string, n double").orderBy("id").collect()]
    assert typed == [(1, "", None), (2, "", None), (3, None, None), (4, "  two\n lines ", 7.0)]
    sinks.csv(spark.createDataFrame(text, "id string, t string, n string"), str(tmp_path / "out"), ["id", "t", "n"])
    assert [tuple(r) for r in readers.csv_text(spark, str(tmp_path / "out")).orderBy("id").collect()] == text


def test_batches_are_ordered_and_united(spark, tmp_path):
    for i, cols in ((10, "a string, b string"), (2, "a string")):
        spark.createDataFrame([("x",) * len(cols.split(","))], cols).coalesce(1).write.csv(str(tmp_path / f"batch_{i}"), header=True)
    got = readers.batches(spark, [str(tmp_path / "batch_10"), str(tmp_path / "batch_2")])
    assert [(r["source_batch"], r["a"]) for r in got.orderBy("source_batch").collect()] == [(2, "x"), (10, "x")]
    with pytest.raises(FileNotFoundError):
        readers.batches(spark, [])


def test_json_documents_and_texts(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"scales": []}')
    (tmp_path / "q.json").write_text("{broken")
    got = {r["file"]: r["record"] for r in readers.json_documents(spark, str(tmp_path)).collect()}
    assert got["p.json"] is not None and got["q.json"] is None
    log = spark.createDataFrame([("p", "ok"), ("none", "ok"), ("q", "error")], "paper_id string, status string")
    texts = {r["paper_id"]: r["text"] for r in readers.paper_texts(spark, log, str(tmp_path)).collect()}
    assert texts == {"p": '{"scales": []}', "none": ""}
    md = tmp_path / "md"
    md.mkdir()
    (md / "x_10.1000@7.md").write_text("seven")
    log = spark.createDataFrame([("a1", "in/x_10.1000@7.pdf", "ok"), ("a2", "x_10.1000@8.pdf", "ok"), ("a3", "x_10.1000@7.pdf", "poor")], "paper_id string, filename string, status string")
    got = readers.paper_texts(spark, log, str(md))
    assert {(r["paper_id"], r["text"]) for r in got.collect()} == {("a1", "seven"), ("a2", "")}
    some = readers.paper_texts(spark, log, str(md), spark.createDataFrame([("a2",)], "paper_id string"))
    assert [r["paper_id"] for r in some.collect()] == ["a2"]


def test_provider_results(spark):
    a = '{"key": "paper-1", "response": {"candidates": [{"content": {"parts": [{"text": "x"}, {"text": "y"}]}, "finishReason": "MAX_TOKENS"}], "usageMetadata": {"promptTokenCount": 5, "candidatesTokenCount": 2}}}'
    r = readers.provider_results(spark.createDataFrame([(a,)], "value string"), "a").first()
    assert (r["paper_id"], r["text"], r["in_tok"], r["truncated"], r["failed"]) == ("1", "xy", 5, True, False)
    b = '{"custom_id": "paper-2", "response": {"status_code": 200, "body": {"choices": [{"message": {"content": "z"}, "finish_reason": "stop"}], "usage": {"prompt_tokens": 1, "completion_tokens": 1}}}}'
    r = readers.provider_results(spark.createDataFrame([(b,)], "value string"), "b").first()
    assert (r["paper_id"], r["text"], r["truncated"], r["failed"]) == ("2", "z", False, False)


def test_provider_errors_are_rows(spark):
    def provider(prompt):
        if prompt == "bad":
            raise RuntimeError("no")
        return prompt.upper()

    df = spark.createDataFrame([("1", "ok"), ("2", "bad")], "paper_id string, prompt string")
    got = {r["paper_id"]: (r["text"], r["error"]) for r in incremental.answered(df, provider, 2).collect()}
    assert got == {"1": ("OK", None), "2": (None, "no")}


def test_schema_forms():
    schema = S.json_schema(S.RECORD, {"study_type": S.STUDY_TYPES})
    assert schema["additionalProperties"] is False and "paper" in schema["required"]
    assert schema["properties"]["paper"]["properties"]["study_type"]["enum"] == S.STUDY_TYPES
    plain = S.for_vendor("nullable", enums={"study_type": S.STUDY_TYPES}, notes={"year": "as printed", "scales": "all of them"})
    assert "additionalProperties" not in str(plain) and plain["properties"]["paper"]["properties"]["year"] == {"type": "integer", "nullable": True, "description": "as printed"}
    assert plain["properties"]["scales"]["description"] == "all of them" and "description" not in plain["properties"]["scales"]["items"]
    assert S.for_vendor("strict")["json_schema"]["strict"] is True
    slim = S.for_vendor("tool", S.JUDGE_RECORD)
    assert slim["strict"] is True and slim["description"] and "scales" not in slim["input_schema"]["properties"]
    full = S.for_vendor("tool", strict=False)
    assert "strict" not in full and "scales" in full["input_schema"]["properties"]
    with pytest.raises(ValueError):
        S.for_vendor("other")


def test_tiered_asks_once_for_each_column(spark):
    """Eight tables asked by two columns are two narrow rows an item, without its long keys."""
    tables = [spark.createDataFrame([(f"{k}{i}" * 500, c, ) for k, c in (("a", f"A{i}"), ("b", ""))], "key string, code string") for i in range(8)]
    items = spark.createDataFrame([(1, "a3" * 500, "a1" * 500), (2, "a6" * 500, ""), (3, "b2" * 500, None), (4, "a1" * 500, "a2" * 500)], "row_id long, x string, y string")
    got = remap.tiered(items, tables, ["x", "y"] * 4)
    assert sorted((r.row_id, r.code, r.tier) for r in got.collect()) == [(1, "A1", 2), (2, "A6", 7), (3, None, None), (4, None, None)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    made = [line for line in plan.splitlines() if "Generate explode" in line]
    assert made and all(line.count("md5") <= 2 for line in made) and "md5" in plan


def test_the_pattern_of_unsafe_characters_tells_ascii_apart_first(spark):
    codes = [c for c in range(0x11000) if not 0xD800 <= c < 0xE000]
    chars = spark.createDataFrame([(c, chr(c)) for c in codes], "n int, c string").repartition(4)
    for but in ("", "\\xa0"):
        odd = chars.where(F.col("c").rlike(T._unsafe(but)) != F.col("c").rlike(f"[^{T._SAFE}{but}]"))
        assert odd.count() == 0
