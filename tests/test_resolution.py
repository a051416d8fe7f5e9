"""Clusters, pairs, batches and evidence against plain sequential code, in all their ways."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from attesta.functions import text as T
from attesta.operators import cluster, evidence, packing

SCALES = "paper_id string, ord int, key string, tokens array<string>, extra int"


def overlap(a, b):
    return len(a & b) / min(len(a), len(b)) if a and b else 0


def scales(seed, n, papers=3, pool=14, hot=None):
    rng, out = random.Random(seed), []
    for i in range(n):
        paper = "p0" if rng.random() < 0.5 else f"p{rng.randrange(papers)}"
        tokens = rng.sample([f"w{j}" for j in range(pool)], rng.choice([0, 1, 2, 3, 3, 4, 5, 6]))
        key = rng.choice(["", None, f"k{rng.randrange(n // 3 + 1)}", " ".join(tokens)])
        out.append((paper, i, key, tokens or rng.choice([[], None]), 7))
    return out


def founders(rows, similar=0.6):
    """Cluster of each (paper, ord), one scale after another."""
    heads, spot = defaultdict(list), {}
    for paper, at, key, tokens, _ in sorted(rows, key=lambda r: r[1]):
        words, own = set(tokens or []), heads[paper]
        hit = next((i for i, (k, _) in enumerate(own) if key and k == key), None)
        if hit is None:
            hit = next((i for i, (_, h) in enumerate(own) if overlap(h, words) >= similar), None)
        if hit is None:
            hit = len(own)
            own.append((key, words))
        spot[paper, at] = hit
    return spot


@pytest.mark.parametrize(("seed", "few"), [(1, 0), (2, 0), (3, 30), (4, 10**6)])
def test_clusters(spark, seed, few):
    rows = scales(seed, 90)
    got = cluster.clustered(spark.createDataFrame(rows, SCALES).repartition(3), few=few)
    assert got.columns == ["paper_id", "ord", "key", "tokens", "extra", "cluster"]
    held = got.collect()
    assert len(held) == len(rows)
    assert {(r.paper_id, r.ord): r.cluster for r in held} == founders(rows)


def test_a_chain_of_scales_that_decide_each_other(spark):
    """Each is like the next only, so every second one founds; names stand for themselves where there are no words."""
    rows = [("p", i, f"k{i}", [f"a{i}", f"a{i + 1}", f"b{i}", f"b{i + 1}"][:: 1 if i % 2 else -1], 0) for i in range(12)]
    rows = [(p, i, k, [f"a{i}", f"a{i + 1}"], x) for p, i, k, _, x in rows] + [("p", 20 + i, "same", [], 0) for i in range(5)]
    for similar in (0.5, 0.6):
        got = cluster.clustered(spark.createDataFrame(rows, SCALES), similar=similar, few=0)
        assert {(r.paper_id, r.ord): r.cluster for r in got.collect()} == founders(rows, similar)


def test_no_scales(spark):
    assert cluster.clustered(spark.createDataFrame([], SCALES)).collect() == []
    empty = spark.createDataFrame([], "by string, ord int, key string, tokens array<string>")
    assert cluster.matched(empty, empty, "by").collect() == []


def test_similar_pairs(spark):
    a, b = scales(5, 60), scales(6, 70)
    kind = "by string, id int, key string, tokens array<string>, extra int"
    got = cluster.similar_pairs(spark.createDataFrame(a, kind), spark.createDataFrame(b, kind), 0.6).collect()
    want = {(p, i, j, round(s, 9)) for p, i, _, t, _ in a for q, j, _, u, _ in b if p == q and (s := overlap(set(t or []), set(u or []))) >= 0.6}
    assert sorted((r.by, r.a, r.b, round(r.similarity, 9)) for r in got) == sorted(want)


def one_to_one(a, b, similar=0.6):
    out = []
    for paper in {r[0] for r in a + b}:
        left, right = ([r for r in x if r[0] == paper] for x in (a, b))
        by_key, used = {r[2] or "": r for r in right}, set()
        for r in left:
            m = by_key.get(r[2] or "")
            if m is None:
                near = [(x, overlap(set(r[3] or []), set(x[3] or []))) for x in right if (x[2] or "") not in used]
                near = [x for x in near if x[1] >= similar]
                m = max(near, key=lambda x: x[1])[0] if near else None
            if m is not None and (m[2] or "") not in used:
                out.append((paper, "pair", r[1], m[1]))
                used.add(m[2] or "")
            else:
                out.append((paper, "only_a", r[1], None))
        out += [(paper, "only_b", None, r[1]) for r in right if (r[2] or "") not in used]
    return out


@pytest.mark.parametrize("few", [0, 40, 10**6])
def test_one_to_one_pairs(spark, few):
    kind = "by string, ord int, key string, tokens array<string>, extra int"
    a, b = scales(7, 80), scales(8, 60)
    got = cluster.matched(spark.createDataFrame(a, kind), spark.createDataFrame(b, kind), "by", few=few).collect()
    assert sorted(map(repr, ((r.by, r.kind, r.ord_a, r.ord_b) for r in got))) == sorted(map(repr, one_to_one(a, b)))


def test_merged_lists(spark):
    rows = [("p", 1, "k", ["a", "b"], "Trust; hope", False, 0), ("p", 2, "longer", ["a", "b", "c"], " HOPE ;fear;", True, 0), ("p", 3, "z", ["q"], None, False, 1)]
    held = spark.createDataFrame(rows, "paper_id string, ord int, key string, tokens array<string>, subscales string, attested boolean, cluster int")
    items = spark.createDataFrame([("p", 2, 0, "x"), ("p", 1, 5, "y"), ("p", 1, 2, "x")], "paper_id string, ord int, item int, key string")
    got = {r.cluster: (r.base, r.subscales, r.attested, r["items"]) for r in cluster.merged(items, held).collect()}
    assert got == {0: ("longer", "Trust; hope; fear", True, ["x", "y"]), 1: ("z", "", False, None)}


def next_fit(rows, budget, ceiling):
    out, state = {}, {}
    for q, i, s in sorted(rows, key=lambda r: (repr(r[0]), r[1])):
        s = s or 0
        batch, used, held = state.get(q, (-1, 0, 0))
        if batch < 0 or used + s > budget or held >= ceiling:
            batch, used, held = batch + 1, 0, 0
        state[q] = batch, used + s, held + 1
        out[q, i] = batch
    return out


@pytest.mark.parametrize(("n", "budget", "ceiling", "block"), [(400, 50, 5, 8), (400, 50, 5, 5), (90, 1000, 3, 512), (7, 1, 4, 4), (300, 40, 1, 2)])
def test_batches(spark, n, budget, ceiling, block):
    rng = random.Random(n + ceiling)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), i, rng.choice([0, 1, 5, 12, 30, 49, 50, 51, 300, None])) for i in range(n)]
    df = spark.createDataFrame(rows, "queue string, i int, size long").withColumn("note", F.lit("x"))
    got = packing.batches(df.repartition(4), "size", ["i"], budget, ceiling, "queue", block=block)
    assert got.columns == ["queue", "i", "size", "note", "batch"] and dict(got.dtypes)["batch"] == "bigint"
    assert {(r.queue, r.i): r.batch for r in got.collect()} == next_fit(rows, budget, ceiling)


def test_no_batches(spark):
    assert packing.batches(spark.createDataFrame([], "queue string, i int, size long"), "size", ["i"], 10, 2, "queue").collect() == []


def test_evidence_by_rarest_runs(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcÅ.") for _ in range(rng.randint(1, 9)))
    texts = [" ".join(word() for _ in range(rng.randint(0, 12))) for _ in range(60)] + ["x" * 3_000, "abc" * 900]
    needles = [t[i : i + rng.randint(1, 14)] for t in texts[:50] for i in [rng.randrange(max(1, len(t)))]] + ["x" * 40, "bcab", "a", "zz", " ", "", "cab abc"]
    src, ask = spark.createDataFrame(list(enumerate(texts)), "id int, s string"), spark.createDataFrame(list(enumerate(needles)), "n int, k string")
    want = sorted((i, n) for i, t in enumerate(texts) for n, k in enumerate(needles) if k and k in t)
    for gram in (1, 3, 4):
        got = evidence.evidence_pairs(ask, "k", src, "s", most_bytes=0, gram=gram).collect()
        assert sorted((r.id, r.n) for r in got) == want


def test_evidence_of_frequent_halves(spark, monkeypatch):
    """Halves that all texts have meet a text only where they are neighbours."""
    monkeypatch.setattr(evidence, "MANY", 3)
    texts = [f"xab cdy w{i} cd ab" for i in range(40)] + ["ab cd", "zab\tcdz", "cd", "", None, "ab\u00a0cd"]
    src = spark.createDataFrame(list(enumerate(texts)), "id int, s string")
    ask = spark.createDataFrame(list(enumerate(["ab cd", "b cdy w1", "d a", "cd w1", "ab\tcd", "none ab"])), "n int, k string")
    want = sorted((i, n) for i, t in enumerate(texts) for n, k in enumerate(r.k for r in ask.collect()) if t and k in t)
    assert sorted((r.id, r.n) for r in evidence.evidence_pairs(ask, "k", src, "s", most_bytes=0).collect()) == want
    two = spark.createDataFrame([(7, "d", "ab"), (8, "y", "ab"), (9, "none", "ab")], "__n long, head string, tail string")
    known = src.select(F.explode(F.array_distinct(F.split("s", r"\s+"))).alias("__word")).where("__word <> ''").groupBy("__word").agg(F.count("*").alias("c"))
    ends, near = evidence._by_halves(two, known, src.withColumnRenamed("id", "__h"), "s")
    assert ends.count() == 0
    assert {r["__n"] for r in near.collect()} == {7} and near.count() == 40


def test_costs_are_decimal(spark):
    rows = [(i, o) for i in (0, 1, 50_000, 100_000, 7) for o in (4, 12, 20, 28, 36, 123_456)]
    df = spark.createDataFrame(rows, "i long, o long").select("i", "o", T.cost(F.col("i"), F.col("o"), 0.15, 1.25).alias("c"))
    for r in df.collect():
        whole, rest = divmod(r.i * 15 + r.o * 125, 1000)
        assert r.c == (whole + (rest > 500 or (rest == 500 and whole % 2 == 1))) / 100_000


def test_exact_medians(spark):
    from attesta.operators import queue

    rng = random.Random(3)
    for values in ([5], [1, 2], [3, 3, 3, 9], [rng.randrange(-(10**6), 10**6) for _ in range(501)], [2**62, 2**62 + 1, -(2**62), 7], [rng.random() * 10 ** rng.randrange(-9, 9) for _ in range(200)], [1.0, 1.0000000000000002, 5e300, -5e300]):
        kind = "double" if isinstance(values[0], float) else "long"
        df = spark.createDataFrame([(v,) for v in [*values, None]], f"v {kind}")
        held, n = sorted(values), len(values)
        assert queue.median(df, "v") == (float(held[(n - 1) // 2]) + float(held[n // 2])) / 2 if n % 2 == 0 else float(held[n // 2])
        for i in rng.sample(range(n), min(n, 2)):
            assert queue.nth(df.where("v is not null"), "v", i) == held[i]
    assert queue.median(spark.createDataFrame([], "v long"), "v") is None


def test_split_counts_what_it_writes(spark, tmp_path):
    from attesta.operators import audit

    rows = spark.createDataFrame([(i, "kept" if i % 3 == 0 else "removed" if i % 3 == 1 else None) for i in range(10)], "i int, o string")
    kept, counts = audit.split(rows, F.col("o"), str(tmp_path / "t"))
    assert counts == {"input": 10, "kept": 4, "removed": 3, "unaccounted": 3}
    assert sorted(r.i for r in kept.collect()) == [0, 3, 6, 9] and kept.columns == ["i", "o"]
    none, counts = audit.split(rows.limit(0), F.col("o"), str(tmp_path / "e"))
    assert none.collect() == [] and counts["input"] == 0


def test_versions_swap_whole_tables(spark, tmp_path):
    from attesta.sources import versions

    at = str(tmp_path / "ledger")
    rows = lambda *r: spark.createDataFrame(r, "k string, v int, pos long")
    held = lambda: sorted((r.k, r.v, r.pos) for r in versions.read(spark, at).collect())
    with pytest.raises(FileNotFoundError):
        versions.read(spark, at)
    assert versions.upsert(rows(("a", 1, 0), ("b", 1, 1)), at, "k", "pos") == 1
    assert versions.upsert(rows(("c", 2, 0), ("a", 2, 1)), at, "k", "pos") == 2
    assert held() == [("a", 2, 0), ("b", 1, 1), ("c", 2, 2)]
    # dies after it has written and before the swap: readers see the old rows, and the run can come again
    dead = versions.stage(rows(("x", 9, 0)), at)
    assert held()[0][0] == "a" and versions.version(spark, at) == 2
    # dies within the swap: an entry without contents is none
    (tmp_path / "ledger" / "_manifest" / f"{3:010d}").write_bytes(b"")
    assert versions.version(spark, at) == 2
    assert versions.upsert(rows(("d", 3, 0)), at, "k", "pos") == 3 and len(held()) == 4
    # of two writers that began from one version, the second fails
    late = versions.stage(rows(("y", 9, 0)), at)
    with pytest.raises(versions.Conflict):
        versions.swap(spark, at, late, 2)
    assert versions.clean(spark, at, keep=1) == 4 and len(held()) == 4
    assert not (tmp_path / "ledger" / dead).exists()


def test_recall_against_final_records(spark):
    from attesta.operators import ledger

    final = spark.createDataFrame([("p", "items", "a"), ("p", "items", "b"), ("p", "items", "a"), ("p", "items", ""), ("p", "scales", "s"), ("q", "items", "c")], "paper string, kind string, key string")
    given = spark.createDataFrame([("x", "p", "items", "a"), ("x", "p", "items", "z"), ("x", "p", "scales", "s"), ("y", "q", "items", "c"), ("y", "q", "items", "c")], "src string, paper string, kind string, key string")
    ran = spark.createDataFrame([("x", "p"), ("x", "q"), ("y", "q"), ("z", "r")], "src string, paper string")
    got = {r.src: (r.papers, r.scales_recall, r.items_recall) for r in ledger.record_recall(final, given, ran, "src", "paper").collect()}
    assert got == {"x": (2, 1.0, 0.25), "y": (1, None, 1.0), "z": (1, None, None)}


def test_eight_look_ups_in_order(spark):
    from attesta.operators import remap

    items = spark.createDataFrame([(1, "Tell me.", "x"), (2, "tell me", None), (3, "none", "to tell"), (4, "totell", "q"), (5, "old one", "tell me"), (6, "nothing", "old"), (7, "zz", "zz")], "row_id long, o string, e string")
    table = lambda **codes: spark.createDataFrame([(k.replace("_", " "), v) for k, v in codes.items()], "key string, code string")
    got = remap.fallback(items, (table(tell_me="n1", none=""), table(totell="n2")), (table(old_one="p1", old="p1e"), table(zz="p2")), "o", "e")
    assert {r.row_id: (r.code, r.tier) for r in got.collect()} == {1: ("n1", 1), 2: ("n1", 1), 3: ("n2", 4), 4: ("n2", 3), 5: ("n1", 2), 6: ("p1e", 6), 7: ("p2", 7)}


def test_firsts_of_long_lists(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice(["A", "a", " b", "B ", "c", "", "Ä", "ä"]) for _ in range(n)]) for i, n in enumerate((0, 1, 2, 30, 3_000))]
    got = {r.i: r.m for r in spark.createDataFrame(rows, "i int, l array<string>").select("i", T.merged_list(F.array_join("l", ";")).alias("m")).collect()}
    for i, parts in rows:
        seen = {}
        for p in (p.strip(" ") for p in parts):
            if p:
                seen.setdefault(p.lower(), p)
        assert got[i] == "; ".join(seen.values())


def test_matched_scales_on_odd_texts(spark, tmp_path):
    import __spark_entry__ as entry
    import duckdb

    # the second names share 20 and 19 of 21 words with the first one: as alike in tenths, so the first of them goes with it
    words = [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(-401, "x y\nx y"), (-1, "lone name\nlone name"), (0, " ".join(words) + "\nother"), (1, "p q r\n" + " ".join(words[:19] + ["no"])), (2, None), (3, "s t u\n" + " ".join(words) + " and"), (5, "\n"), (199, "one")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = entry.queries()["matched_scales"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"select paper, kind, ord_a, ord_b from ({entry.oracle_sql()['matched_scales']})").fetchall()
    assert (0, 1) in {(a, b) for _, kind, a, b in want if kind == "pair"}
    assert sorted(map(tuple, got.select("paper", "kind", "ord_a", "ord_b").collect())) == sorted(want)


def test_fuzzy_pairs_of_copies(spark, monkeypatch):
    """Scales of equal words are searched once and what has its key among B not at all; each still has its own best, ids may come twice."""
    rng, kind = random.Random(3), "g int, id int, key string, tokens array<string>"
    side = lambda n, start: [(rng.randrange(2), start + i % (n - 4), rng.choice([None, f"k{rng.randrange(12)}", f"{start}-{i}"]), rng.choice([None, [], rng.sample("abcdefg", rng.randrange(1, 5))])) for i in range(n)]
    a, b = side(60, 0), side(60, 100)
    a += [(0, 200 + i, f"n{i}", ["x", "y"]) for i in range(40)]
    b += [(0, 300 + i, f"m{i}", ["y", "x"]) for i in range(40)]
    want = {}
    for g, i, k, t, h, j, m, u in ((*x, *y) for x in a for y in b):
        s = overlap(set(t or []), set(u or []))
        if g == h and (k == m is not None or s >= 0.6):
            best = (0, -1.0, j) if k == m is not None else (1, -s, j)
            want[g, i] = min(want.get((g, i), best), best)
    seen, similar = [], cluster.similar_pairs
    monkeypatch.setattr(cluster, "similar_pairs", lambda x, y, *z: (seen.append((x.where("by = 0 and array_contains(tokens, 'x')").count(), y.where("by = 0 and array_contains(tokens, 'x')").count())), similar(x, y, *z))[1])
    got = cluster.fuzzy_pairs(spark.createDataFrame(a, kind), spark.createDataFrame(b, kind), "g").collect()
    assert sorted((r.g, r.id_a, r.id_b, round(r.similarity, 9)) for r in got) == sorted((*k, j, round(-s, 9)) for k, (_, s, j) in want.items())
    assert seen == [(1, 1)]


def test_evidence_meets_little_else(spark):
    """Needles of two words whose halves many texts have, but seldom beside each other: hardly more is found than comes out, also in a
    text that is searched in pieces, of characters of several bytes, and for needles and texts that come twice."""
    from attesta.operators import runs

    rng = random.Random(17)
    parts = ["an", "er", "zü", "日本", "tion", "xa."]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    texts = [" ".join(word() for _ in range(40)) for _ in range(120)] + [None, "", "日", "an" * runs.SPAN + "zü" + " ".join(word() for _ in range(60_000))]
    texts += texts[:2]
    needles = {f"{word()} {word()}" for _ in range(500)} | {texts[123][i : i + n] for n in (1, 2, 7, 64, 3_000) for i in (runs.SPAN - 1, 2 * runs.SPAN - 2, 2 * runs.SPAN + 70_000)} | {"no such needle", "日本日", "an" * 5_000}
    needles = [*sorted(needles), "日本日"]
    src, ask = spark.createDataFrame(list(enumerate(texts)), "id int, s string").repartition(3), spark.createDataFrame(list(enumerate(needles)), "n int, k string")
    want = sorted((i, n) for i, t in enumerate(texts) for n, k in enumerate(needles) if t and k in t)
    found, seen = runs.found, []
    runs.found = lambda *a: seen.append(found(*a)) or seen[-1]
    try:
        for carry in (None, ["id"]):
            got = evidence.evidence_pairs(ask, "k", src, "s", most_bytes=0, carry=carry)
            assert got.columns == ["id", *["s"] * (carry is None), "n", "k"]
            assert sorted((r.id, r.n) for r in got.collect()) == want
    finally:
        runs.found = found
    assert all(x.count() <= 1.1 * len(want) for x in seen)
    assert evidence.evidence_pairs(ask.limit(0), "k", src, "s", most_bytes=0).collect() == []


def test_similar_pairs_in_blocks(spark):
    """A paper of many words is dealt into blocks, small papers share a task; no words are dealt out, so candidates are never shuffled."""
    kind = "by string, id long, key string, tokens array<string>, extra int"
    a, b = scales(21, 70, papers=9), scales(22, 60, papers=9)
    want = lambda x, y: sorted((p, i, j, round(s, 9)) for p, i, _, t, _ in x for q, j, _, u, _ in y if p == q and (x is not y or i != j) and (s := overlap(set(t or []), set(u or []))) >= 0.6)
    one, two = spark.createDataFrame(a, kind), spark.createDataFrame(b, kind.replace("id long", "id string"))
    for most in (20, 500_000):
        own, met = cluster.similar_pairs(one, most=most), cluster.similar_pairs(one, two, most=most)
        assert sorted((r.by, r.a, r.b, round(r.similarity, 9)) for r in own.collect()) == want(a, a)
        assert sorted((r.by, r.a, int(r.b), round(r.similarity, 9)) for r in met.collect()) == want(a, b)
        plan = own._jdf.queryExecution().toString()
        assert "tokens" in plan and "explode(tokens" not in plan and "explode(r" not in plan
    assert cluster.similar_pairs(one.limit(0)).collect() == [] == cluster.similar_pairs(one, two.limit(0)).collect()


def test_similar_sets_of_many_words():
    """Candidates and their words are looked at in parts."""
    import pyarrow as pa

    from attesta.operators import overlaps

    rng = random.Random(4)
    sets = [sorted(rng.sample(range(60), rng.choice([1, 2, 5, 9, 30]))) for _ in range(150)]
    table = pa.table({"by": [i % 2 for i in range(150)], "tokens": [[f"w{x}" for x in s] for s in sets]})
    want = sorted((i, j) for i in range(150) for j in range(i) if i % 2 == j % 2 and overlap(set(sets[i]), set(sets[j])) >= 0.6)
    held = overlaps.SPAN
    try:
        for overlaps.SPAN in (7, held):
            got = [(int(max(x, y)), int(min(x, y)), s) for part in overlaps.Sets(table, 0.6).pairs(None) for x, y, s in zip(*part, strict=True)]
            assert sorted((x, y) for x, y, _ in got) == want
            assert all(s == overlap(set(sets[x]), set(sets[y])) for x, y, s in got)
    finally:
        overlaps.SPAN = held


def test_resolve_clusters_on_odd_texts(spark, tmp_path):
    """Names are normalised once: what stands behind a second number is a word of the name."""
    import __spark_entry__ as entry
    import duckdb

    rows = [(1, "1. 2. p\nitem"), (98, "2.\nitem\nitem"), (195, "2. z"), (292, None), (389, "p q"), (485, "x"), (97 * 7 + 1, "(a) 3) p q r s\n\nother"), (97 * 8 + 1, "The scale"), (97 * 9 + 1, "z-z")]
    spark.createDataFrame([(i, t, "de" if i % 2 else "en") for i, t in rows], "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = entry.queries()["resolve_clusters"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"select paper_id, cluster, base, subscales, n_items from ({entry.oracle_sql()['resolve_clusters']})").fetchall()
    assert sorted(map(tuple, got.select("paper_id", "cluster", "base", "subscales", "n_items").collect())) == sorted(want)
