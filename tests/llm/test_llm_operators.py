"""Each operator against brute force, on odd tables: nulls in any column, empty and long texts, ties,
repeated rows, empty tables, and other columns whose names an operator also uses."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from attesta.llm import embed_dedup, lines, minhash, mixing, order, packing, sharding, suffix_dedup, tokens, topk, toxicity
from attesta.llm.runtime import components, ranked

# columns of documents, and some that clash with names inside the operators
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, score double, component string, a string, rank int, key string, k long, row string, doc string, part int, target string, line string"
EXTRA = (1, 2, 0.5, "x", "y", 3, "z", 9, "r", "d", 4, "t", "l")


def words(rng, n, pool):
    return " ".join(rng.choice(pool) for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), *EXTRA) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(400)] + ["Über", "naïve", "tab\tbed", "x."]
    base = [words(rng, 60, pool) for _ in range(12)]
    near = base[0].split(" ")
    near[30] = "CHANGED"
    passage = words(rng, 40, pool)
    rows = [(i, t, f"s{i % 4}") for i, t in enumerate(base)]
    rows += [
        (20, base[0], "s0"), (21, base[0].upper(), "s1"), (22, " ".join(near), "s0"), (23, None, "s0"), (24, "", None), (25, " \n\t ", "s2"),
        (26, "one two three", "s1"), (27, "ONE two\nthree", "s1"), (28, words(rng, 20, pool) + passage, "s0"), (29, words(rng, 7, pool) + "\n" + passage + "\n" + words(rng, 9, pool), None),
        (30, words(rng, 20_000, pool), "s3"), (31, "ab" * 300, "s3"), (32, "spam " * 400, "s0"), (None, base[1], "s0"), (None, None, None), (33, base[2], None), (33, base[2], None), (33, base[3], "s1"),
    ]
    return rows


def both(spark, odd):
    return table(spark, odd), table(spark, [])


# shared parts


def test_components_of_a_path_and_a_star(spark, monkeypatch):
    import attesta.llm.runtime as runtime

    monkeypatch.setattr(runtime, "LOCAL_EDGES", 8)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 199), (200, 199)]
    random.Random(1).shuffle(edges)
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 199: 199, 200: 199}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ranks_and_sums(spark):
    df = spark.createDataFrame([(i, i % 3 + 1) for i in range(50)], "i long, w long").repartition(7)
    got = {r["i"]: (r["n"], r["s"]) for r in ranked(ranked(df, ["i"], "n"), ["i"], "s", "w").collect()}
    assert got == {i: (i, sum(j % 3 + 1 for j in range(i))) for i in range(50)}


# op1


def test_mix_meets_its_targets(spark, odd):
    full, none = both(spark, odd)
    got = mixing.mix(full).collect()
    assert len(got) == len(odd) and mixing.mix(none).count() == 0
    sizes = defaultdict(int)
    for _, t, s in odd:
        sizes[s] += len((t or "").split())
    per = {r["source"]: (r["source_size"], r["target"]) for r in got}
    assert {s: v[0] for s, v in per.items()} == dict(sizes)
    assert sum(v[1] for v in per.values()) == pytest.approx(min(sum(sizes.values()), 3 * sum(sizes.values())))
    names = sorted((s for s in sizes if s is not None)) + [None]
    free = [s for s in names if per[s][1] < 3 * sizes[s] - 1e-6]
    level = {round(per[s][1] / ((names.index(s) % 3) + 1), 6) for s in free}
    assert len(level) == 1
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for s in names:
        largest = max(r["size"] for r in got if r["source"] == s)
        assert abs(taken[s] - per[s][1]) <= largest
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(full.repartition(5)).collect()))


def test_mixed_rows_come_as_often_as_taken(spark, odd):
    full, none = both(spark, odd)
    want = Counter()
    for r in mixing.mix(full).collect():
        want[r["doc_id"], r["size"]] += r["copies"]
    out = mixing.mixed(full)
    assert out.columns == full.columns and mixing.mixed(none).count() == 0
    got = Counter((r["doc_id"], len((r["text"] or "").split())) for r in out.collect())
    assert got == Counter({k: v for k, v in want.items() if v})


def test_nested_budgets(spark):
    rows = [(i, "w " * (i % 7 + 1), "s") for i in range(300)]
    base = table(spark, rows).select("source", mixing.words(F.col("text")).alias("__size"), mixing.hash60(F.col("doc_id")).alias("__hash"))
    total = sum(i % 7 + 1 for i in range(300))
    last = -1
    for share in (0.1, 0.4, 0.7):
        goal = spark.createDataFrame([("s", total, total * share)], "source string, source_size long, target double")
        below = mixing.thresholds(base, goal, True).first()["below"]
        assert below > last
        assert base.where(F.col("__hash") < below).agg(F.sum("__size")).first()[0] == pytest.approx(total * share, abs=7)
        last = below


# op2


def brute_links(x, t):
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hit = unit @ unit.T >= t
    np.fill_diagonal(hit, False)
    return hit


def test_embedding_links(spark):
    rng = np.random.default_rng(3)
    heads = rng.standard_normal((12, 16))
    x = np.concatenate([heads + 0.08 * rng.standard_normal((12, 16)) for _ in range(6)] + [rng.standard_normal((60, 16))]).astype(np.float32).astype(float)
    x[5] = x[4]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [float("inf")] + [0.0] * 15, 1), (904, [], 1), (905, [None] + [1.0] * 15, 1), (906, [0.0, -0.0] + [1e-30] * 14, 1), (907, [1e300] * 16, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit("clash")).withColumn("v", F.lit(1))
    hit = brute_links(x, 0.95)
    got = {r["vec_id"]: r for r in embed_dedup.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    label = list(range(len(x)))
    for _ in label:
        label = [min([label[j] for j in np.flatnonzero(hit[i])] + [label[i]]) for i in range(len(x))]
    for i in range(len(x)):
        assert got[i]["n_links"] == hit[i].sum() and got[i]["component_id"] == label[i] and got[i]["kept"] == (label[i] == i)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (900, 901, 902, 903, 904, 905))
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_large_keys_are_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 8)
    rng = np.random.default_rng(4)
    x = rng.standard_normal(8) + 0.05 * rng.standard_normal((50, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    hit = brute_links(x, 0.95)
    got = {r["vec_id"]: r["n_links"] for r in embed_dedup.near_duplicates(df).collect()}
    assert got == {i: int(hit[i].sum()) for i in range(50)}


def test_estimates_are_unbiased_and_bounds_hold():
    """Over rotations the estimate's mean is the cosine, its spread is what the bound says, and the bound at the
    confidence used keeps all of very many pairs at the threshold."""
    rng = np.random.default_rng(8)
    o = rng.standard_normal(32)
    o /= np.linalg.norm(o)
    other = rng.standard_normal(32)
    other -= (other @ o) * o
    q = 0.95 * o + np.sqrt(1 - 0.95**2) * other / np.linalg.norm(other)
    found, deviation = [], []
    for seed in range(400):
        codes = embed_dedup.Codes(32, 4, 4, 2 * seed)
        pack = lambda code, v: code.decode(*[x if i else [r.tobytes() for r in np.packbits(x, axis=1)] for i, x in enumerate(code.encode(v[None]))])
        (_, x, e), (_, y, f) = pack(codes.one, o), pack(codes.two, q)
        assert x[0] @ o == pytest.approx(1) and y[0] @ q == pytest.approx(1)
        found.append(x[0] @ y[0])
        deviation.append((0.95 - codes.need(e, f, 0.95)[0, 0]) / embed_dedup.CONFIDENCE)
        assert found[-1] >= codes.need(e, f, 0.95)[0, 0]
    assert np.mean(found) == pytest.approx(0.95, abs=4 * np.mean(deviation) / 20)
    assert np.std(found) == pytest.approx(np.mean(deviation), rel=0.2)


def test_codes_leave_few_pairs_out_of_reach(spark):
    """Random vectors: the estimates settle nearly all pairs that meet."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((600, 64))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    codes = embed_dedup.Codes(64, *embed_dedup.plan(600, 0.95))
    (one, a), (two, b) = codes.one.encode(unit), codes.two.encode(unit)
    part = {"one": [r.tobytes() for r in np.packbits(one, axis=1)], "two": [r.tobytes() for r in np.packbits(two, axis=1)], "a": a, "b": b, "mine": 0, "x": 0, "y": 0}
    left = sum(len(i) for i, _ in embed_dedup._pairs(codes, 0.95, 0, embed_dedup.pd.DataFrame(part)))
    assert left < 0.001 * 600 * 599 / 2


def test_rows_of_one_id_are_judged_each_by_its_own_vector(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, a), (1, b), (2, [0.01, 1.0, 0.0]), (3, a), (3, a)]
    got = Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())
    assert got == Counter([(1, 2, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 2, 1, False), (3, 2, 1, False)])


# op3


def test_shards(spark, odd):
    full, none = both(spark, odd)
    got = sharding.shard(full, 4).collect()
    assert len(got) == len(odd) and sharding.shard(none, 4).count() == 0
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in odd)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want


@pytest.mark.parametrize("hot", ["copies", "empty", "one row again and again"])
def test_hot_texts_are_subdivided(spark, hot):
    rng = random.Random(2)
    rows = [(i, words(rng, 30, ["a", "bc", "def"]), "s") for i in range(2000)]
    rows += [(5000 + i, {"copies": "x" * 90, "empty": ""}.get(hot, "y" * 90), "s") for i in range(1000)] if "again" not in hot else [(7, "y" * 90, "s")] * 1000
    got = sharding.shard(table(spark, rows), 8).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() < 1.03 * sizes.mean() and sizes.min() > 0.97 * sizes.mean()
    if hot == "empty":
        assert got.groupby("shard").slot.apply(lambda s: sorted(s) == list(range(len(s)))).all()


# op4


def sets_of(text, k=5):
    w = [x for x in _split(text)]
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def _split(text):
    import re

    table = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))


def test_minhash_components(spark, odd):
    assert minhash.near_duplicates(table(spark, odd)).where("doc_id = 33").select("component_id").distinct().count() == 2  # row by row
    odd = odd[:-1]
    full, none = both(spark, odd)
    got = minhash.near_duplicates(full).collect()
    assert len(got) == len(odd) and minhash.near_duplicates(none).count() == 0
    vertices = {}
    for i, t, _ in odd:
        vertices.setdefault(i, []).append(sets_of(t))
    ids = sorted(vertices, key=lambda i: -1 if i is None else i)
    label = {i: n for n, i in enumerate(ids)}
    link = lambda a, b: a and b and 100 * len(a & b) >= 85 * len(a | b)
    for _ in ids:
        for i in ids:
            for j in ids:
                if any(link(a, b) for a in vertices[i] for b in vertices[j]):
                    label[i] = label[j] = min(label[i], label[j])
    for r in got:
        assert r["component_id"] == ids[label[r["doc_id"]]], r
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert Counter((r["doc_id"], r["n_shingles"]) for r in got) == Counter((i, len(sets_of(t))) for i, t, _ in odd)
    left = minhash.without_near_duplicates(full, 85)
    assert left.columns == full.columns
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in got if r["kept"]} | {None}


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_rows_of_one_id_go_by_their_own_texts(spark, monkeypatch, broadcast):
    monkeypatch.setattr(minhash, "BROADCAST_KEYS", broadcast)
    rng = random.Random(6)
    a, b = (words(rng, 80, [f"w{i}" for i in range(300)]) for _ in range(2))
    rows = [(5, a, "s"), (5, b, "s"), (2, b + " z", "s"), (7, a, "s"), (7, None, "s"), (None, b, "s"), (9, "", "s")]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(table(spark, rows)).collect())
    assert got == Counter([(5, 76, 5, True), (5, 76, None, False), (2, 77, None, False), (7, 76, 5, False), (7, 0, 7, True), (None, 76, None, True), (9, 0, 9, True)])
    left = sorted(((-1 if r["doc_id"] is None else r["doc_id"]), r["text"] or "") for r in minhash.without_near_duplicates(table(spark, rows)).collect())
    assert left == sorted([(5, a), (7, ""), (-1, b), (9, "")])


def test_low_thresholds_are_planned_or_refused(spark):
    for percent in range(25, 100):
        rows, side = minhash.plan(percent)
        assert side <= minhash.MAX_SIDE and 2 * (1 - (percent / 100) ** rows) ** side <= minhash.MISS
    assert minhash.plan(85) == (3, 8) and minhash.plan(80) == (3, 10)
    with pytest.raises(ValueError):
        minhash.plan(10)
    rng = random.Random(12)
    base = [f"w{rng.randrange(999)}" for _ in range(100)]
    other = [*base[:66], *(f"v{i}" for i in range(34))]  # 62 of 130 shingles
    rows = [(1, " ".join(base), "s"), (2, " ".join(other), "s")]
    assert [r["component_id"] for r in minhash.near_duplicates(table(spark, rows), percent=45).collect()] == [1, 1]
    assert sorted(r["component_id"] for r in minhash.near_duplicates(table(spark, rows), percent=50).collect()) == [1, 2]


def test_large_groups_are_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 6)
    rng = random.Random(9)
    pool = [f"w{i}" for i in range(200)]
    base = [rng.choice(pool) for _ in range(120)]
    rows = []
    for i in range(40):
        w = list(base)
        w[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(w), "s"))
    got = minhash.near_duplicates(table(spark, rows)).collect()
    assert {r["component_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


@pytest.mark.parametrize("block", [2048, 2])
def test_near_texts_meet_behind_texts_that_share_passages(spark, monkeypatch, block):
    """In each key of two near texts the least class is another text, made of the six passages that the
    key comes from, and near to neither."""
    monkeypatch.setattr(minhash, "KEY_BLOCK", block)
    rng, shingler = random.Random(31), minhash.Shingler()
    least = lambda t: minhash.minima(next(shingler.sets([t])), 8).reshape(2, 8, 3)
    base = [f"v{i}" for i in range(140)]
    pair = [" ".join([*base[:at], f"only{at}", *base[at + 1 :]]) for at in (20, 90)]
    a, b = map(least, pair)
    windows = [base[i : i + 5] for i in range(136)]
    window = {int(next(shingler.sets([" ".join(w)]))[0]): w for w in windows}
    made = {int(minhash.minima(np.array([h], dtype=np.uint64), 8)[k]): w for h, w in window.items() for k in range(48)}
    texts = []
    for i, j in [(i, j) for i in range(8) for j in range(8) if (a[0, i] == b[0, i]).all() and (a[1, j] == b[1, j]).all()]:
        held = [made[int(v)] for v in (*a[0, i], *a[1, j])]
        for turn in range(10_000):
            rng.shuffle(held)
            text = f" x{i}{j}{turn} ".join(map(" ".join, held))
            c = least(text)
            if (c[0, i] == a[0, i]).all() and (c[1, j] == a[1, j]).all():
                break
        else:
            raise AssertionError("no such text")
        texts.append(text)
    assert len(texts) > 3
    rows = [(i, t, "s") for i, t in enumerate([*texts, *pair])]
    sets = [sets_of(t) for _, t, _ in rows]
    want = {}
    for j, x in enumerate(sets):
        want[j] = min([want[i] for i, y in enumerate(sets[:j]) if 100 * len(x & y) >= 85 * len(x | y)], default=j)
    assert want[len(texts) + 1] == len(texts) and len(set(want.values())) == len(rows) - 1
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(table(spark, rows)).collect()}
    assert got == want


def test_tables_are_pairs_of_half_keys():
    s = np.unique(np.random.default_rng(0).integers(0, 2**63, 500, dtype=np.uint64))
    a, b = minhash.half_keys(minhash.minima(s, 8), 8)
    assert minhash._tables(a[None], b[None]).shape == (1, 64) and minhash.plan(85)[1] == 8 and minhash.plan(80)[1] == 10


# op5


def brute_repeats(odd):
    seen, out = {}, Counter()
    docs = sorted(odd, key=lambda r: -1 if r[0] is None else r[0])
    first = {}
    for i, t, _ in docs:
        b = (t or "").encode()
        for p in range(len(b) - 99):
            k = (-1 if i is None else i, p)
            g = b[p : p + 100]
            first[g] = min(first.get(g, k), k)
    del seen
    for i, t, _ in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            if first[b[p : p + 100]] < (-1 if i is None else i, p):
                gone[p : p + 100] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out[i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("most, batch, heavy", [(4_096, 1 << 17, 1_024), (1, 1 << 17, 0), (4, 300, 0), (4_096, 300, 1_024)])
def test_repeated_passages(spark, odd, monkeypatch, most, batch, heavy):
    """Anchors of any size: by one merge, and cut finer down to whole windows."""
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    monkeypatch.setattr(suffix_dedup, "BATCH", batch)
    monkeypatch.setattr(suffix_dedup, "HEAVY", heavy)
    monkeypatch.setattr(suffix_dedup, "EVERY", 1)
    monkeypatch.setattr(suffix_dedup, "SHARE", 1e-9 if heavy == 0 else 0.25)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7" if batch == 300 else "10000")
    full, none = both(spark, odd)
    got = suffix_dedup.deduplicate(full).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == brute_repeats(odd)
    assert suffix_dedup.deduplicate(none).count() == 0


def test_an_anchor_of_many_snippets_is_cut_finer(spark, monkeypatch):
    """One passage between ever other neighbours, and a counter in it: its anchors have very many snippets."""
    monkeypatch.setattr(suffix_dedup, "MOST", 8)
    rng = random.Random(21)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    one, two = letters(90), letters(130)
    rows = [(i, letters(rng.randrange(30, 90)) + one + str(i % 17) + two + letters(60), "s") for i in range(120)]
    got = suffix_dedup.deduplicate(table(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == brute_repeats(rows)


def test_merged_transforms_sort_all_places():
    rng = np.random.default_rng(6)
    for shards in (1, 3):
        raw = [rng.integers(97, 99, 400, dtype=np.uint8) for _ in range(shards)]
        places, _ = suffix_dedup.merge(raw)
        keys = []
        for s in raw:
            double = np.concatenate([s, s]).tobytes()
            keys += [double[i : i + suffix_dedup.WIDTH] for i in range(len(s))]
        assert [keys[p] for p in places] == sorted(keys)


# op6


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERIES_A_GROUP", 5)
    rng = np.random.default_rng(7)
    x = np.round(rng.standard_normal((200, 8)), 1)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (920, [float("nan")] * 8), (940, [1.0]), (None, [1.0] * 8), (960, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("uid", F.lit("clash")).withColumn("v", F.lit(0))
    got = defaultdict(list)
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=7).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    whole = {i: np.floor(64 * np.pad(np.array(v, float), (0, 8 - len(v)))).astype(int) for i, v in rows if i is not None and v is not None and np.isfinite(v).all()}
    want = {}
    for q in (i for i in whole if i % 20 == 0):
        best = sorted(((-int(whole[q] @ v), i) for i, v in whole.items() if i != q))[:7]
        want[q] = [(n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert got == want
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(few, F.col("vec_id") == 0, k=7).collect()] == [(0, 1, 1, 64 * 128)]


def test_huge_components_are_exact(spark):
    df = spark.createDataFrame([(0, [1e9, 3.0]), (1, [1e9, 5.0]), (2, [1e9, 4.0])], "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in topk.top_k(df, F.col("vec_id") == 0, k=5, scale=1.0).orderBy("rank").collect()]
    assert got == [(1, 10**18 + 15), (2, 10**18 + 12)]


def brute_top(whole, queries, k):
    out = {}
    for q in queries:
        best = sorted(((max(-(2**63) + 1, min(2**63 - 1, sum(a * b for a, b in zip(whole[q], v, strict=True)))), -i) for i, v in whole.items() if i != q), reverse=True)[:k]
        out[q] = [(n, -i, s) for n, (s, i) in enumerate(best, 1)]
    return out


def ranks(df):
    got = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return got


def test_bounds_prune_clustered_vectors(spark, monkeypatch):
    """Few of the pairs of a query and a row are compared where vectors lie in clusters, and none is lost."""
    monkeypatch.setattr(topk, "AT_ONCE", 64)
    monkeypatch.setattr(topk, "QUERIES_A_GROUP", 40)
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((25, 16)) * rng.uniform(0.5, 2, (25, 1))
    x = centre[rng.integers(0, 25, 2000)] + 0.05 * rng.standard_normal((2000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    is_q = F.col("vec_id") % 20 == 0
    whole = {i: [int(c) for c in v] for i, v in enumerate(np.floor(64 * x))}
    assert ranks(topk.top_k(df, is_q, k=5)) == brute_top(whole, range(0, 2000, 20), 5)
    assert topk.compared(df, is_q, k=5) < 0.25 * 100 * 2000


@pytest.mark.parametrize("size", [1e3, 1e9, 1e15, 1e30])
def test_scores_of_any_size_are_exact(size):
    rng = np.random.default_rng(8)
    q, x = (np.floor(rng.standard_normal((n, 5)) * size * 10.0 ** rng.integers(-3, 1, (n, 5))) for n in (7, 30))
    x[::3] = np.floor(rng.standard_normal((10, 5)) * 50)
    want = [[max(-(2**63) + 1, min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(p, r, strict=True)))) for r in x] for p in q]
    assert topk._scores(q, x).tolist() == want


def test_rows_of_one_id_are_candidates_of_each_other(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [2.0, 0.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, F.col("vec_id") == 0, k=2, scale=1.0).collect())
    assert got == [(0, 1, 0, 2)] * 3 + [(0, 2, 0, 1)] * 2 + [(0, 2, 0, 2)]


# op7


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    s = next((i for i, (x, y) in enumerate(zip(a[::-1], b[::-1], strict=False)) if x != y), min(len(a), len(b)))
    return p + s >= max(len(a), len(b)) - 1


def brute_lines(rows, least=6):
    spots = []
    for i, t, _ in rows:
        for n, line in enumerate((t or "").split("\n")):
            w = _words(line)
            if len(w) >= least:
                spots.append(((-1 if i is None else i, n), w))
    out = Counter()
    for i, t, _ in rows:
        held = (t or "").split("\n")
        kept = []
        for n, line in enumerate(held):
            w, at = _words(line), (-1 if i is None else i, n)
            if not (len(w) >= least and any(s < at and near(v, w) for s, v in spots)):
                kept.append(line)
        out[i, 0 if t is None else len(held), len(held) - len(kept), None if t is None else "\n".join(kept)] += 1
    return out


def _words(line):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", line)


def test_lines(spark, odd):
    rng = random.Random(11)
    base = [[rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(n)] for n in (5, 6, 6, 7, 8, 9, 15, 16, 17, 33)]
    rows = [(i, t, s) for i, t, s in odd if i != 33]
    for i in range(60):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w))
            what = rng.randrange(4)
            if what == 0:
                w[at] = "new"
            elif what == 1:
                w.insert(at, "put")
            elif what == 2 and len(w) > 1:
                del w[at]
            else:
                w.insert(0, w.pop(at))
        rows.append((100 + i // 2, None, "s") if i == 7 else (100 + i, "\n".join([" ".join(w), "short line", "  ".join(w[::-1])]), "s"))
    full = table(spark, rows)
    got = Counter((r["doc_id"], r["n_lines"], r["n_removed"], r["kept_text"]) for r in lines.deduplicate(full).collect())
    want = brute_lines(rows)
    assert got - want == want - got == Counter()
    assert lines.deduplicate(full.limit(0)).count() == 0
    left = lines.without_repeats(full)
    assert left.columns == full.columns
    for r in left.collect():
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))


# op8


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    f = order.Feistel(n, 3)
    s = f.slots(np.arange(n))
    assert sorted(s.tolist()) == list(range(n)) and (f.inverse(s) == np.arange(n)).all()
    assert n < 64 or not (s == order.Feistel(n, 4).slots(np.arange(n))).all()


def brute_stream(rows, length):
    """The sequences of the documents in the order of ids (of a hash of the text where these are equal)."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.path_of())
    ids, origin = [], []
    for i, t in rows:
        own = [*tok.encode(t or "", add_special_tokens=False).ids, tokens.END]
        ids += own
        origin += [(i, k) for k in range(len(own))]
    return [(*origin[lo], len(ids[lo : lo + length]), (ids[lo : lo + length] + [tokens.END] * length)[:length]) for lo in range(0, len(ids), length)]


def in_id_order(full):
    return [(r["doc_id"], r["text"]) for r in full.select("doc_id", "text").orderBy("doc_id", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]


@pytest.mark.parametrize("stored", ["dealt", "ranges", "one"])
def test_training_order(spark, odd, stored):
    """The same shards however the table is stored."""
    full, none = both(spark, odd)
    rows = in_id_order(full)
    once = full.dropDuplicates(["doc_id"]).where("doc_id is not null")
    if stored == "ranges":
        full, rows = once.repartitionByRange(9, "doc_id").sortWithinPartitions("doc_id"), in_id_order(once)
    elif stored == "one":
        full = full.coalesce(1)
    path = order.materialise(full, length=50, stride=16)
    got = order.resume(spark, path, 0, 16).orderBy("sequence").toPandas()
    want = brute_stream(rows, 50)
    assert sorted(got.slot) == list(range(len(want))) and (got.shard == got.slot // 16).all()
    assert (order.Feistel(len(got), 17).slots(got.sequence.to_numpy()) == got.slot).all()
    for r, (doc, start, n, ids) in zip(got.itertuples(), want, strict=True):
        assert (None if np.isnan(r.doc_id) else int(r.doc_id), r.start, r.n_tokens) == (doc, start, n)
        assert np.frombuffer(r.tokens, "<u2").tolist() == ids
    assert order.resume(spark, path, 20, 16).count() == len(got) - 20
    for shard in range(-(-len(got) // 16)):  # a file for each shard, in the order of slots
        files = list(Path(path.removeprefix("file:")).glob(f"shard={shard}/*.parquet"))
        assert len(files) == 1
        assert pq.read_table(files[0], columns=["slot"], partitioning=None)["slot"].to_pylist() == list(range(16 * shard, min(16 * shard + 16, len(got))))
    assert order.digest(order.resume(spark, order.materialise(none, length=50, stride=16), 0, 16), 16).count() == 0


def test_in_order_takes_a_sorted_table_as_it_is(spark):
    from attesta.llm import runtime

    docs = spark.range(5000).selectExpr("id as doc_id", "repeat('a', 3) as text")
    kept = runtime.in_order(docs, "doc_id", "text")
    assert docs.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert "Exchange" not in kept._jdf.queryExecution().toString()
    for other in (docs.repartition(3), docs.coalesce(1), docs.unionByName(docs.limit(1)), docs.selectExpr("cast(null as long) doc_id", "text")):
        assert "Exchange" in runtime.in_order(other, "doc_id", "text")._jdf.queryExecution().toString()


# op9


def test_tokens_word_by_word():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokens.path_of())
    mine = tokens.WordTokenizer(tokens.path_of(), kept=50)
    some = st.text(alphabet=st.sampled_from("aBcdé ß́İΣ.,'s!?-09\n\t  漢<|>endoftx"), max_size=60)

    @settings(max_examples=400, deadline=None)
    @given(st.lists(some, max_size=4))
    def same(texts):
        got = [ids.tolist() for ids, _ in mine.many(texts)]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]

    same()
    assert next(mine.many(["it's <|endoftext|> A<|startoftext|>b"]))[0].tolist() == whole.encode("it's <|endoftext|> A<|startoftext|>b", add_special_tokens=False).ids


def test_tokens_of_a_text_with_more_units_than_are_kept():
    import signal

    from tokenizers import Tokenizer

    def late(*_):
        raise TimeoutError("the table of units was full")

    whole, mine = Tokenizer.from_file(tokens.path_of()), tokens.WordTokenizer(tokens.path_of(), kept=50)
    size, held = mine.table.size, signal.signal(signal.SIGALRM, late)
    signal.alarm(60)
    try:
        for text in (" ".join(f"a{i:x}" for i in range(first, first + 4_000)) for first in (0, 2_000)):
            for t in (text, "a few words", text[:9_000]):
                assert next(mine.many([t]))[0].tolist() == whole.encode(t, add_special_tokens=False).ids
            assert mine.table.size == size and len(mine.table.entries) <= 1 << 12
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, held)


def test_tokens_take_bounded_memory():
    import random
    import tracemalloc

    some = random.Random(1)
    words = ["".join(some.choices("abcdefgh", k=some.randint(2, 9))) for _ in range(3_000)]
    texts = [" ".join(some.choices(words, k=700)) + "." for _ in range(400)]
    tracemalloc.start()
    try:
        mine = tokens.WordTokenizer(tokens.path_of())
        assert sum(len(ids) for ids, _ in mine.many(texts)) > 500_000
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()


def test_packing(spark, odd, monkeypatch):
    monkeypatch.setattr(packing, "BUFFER", 700)
    full, none = both(spark, odd)
    assert packing.pack(none).count() == 0
    got = packing.pack(full, size=64).toPandas()
    sizes = got.groupby("sequence_id").length.sum()
    assert sizes.max() <= 64 and sizes.sum() / (64 * len(sizes)) > 0.9
    by = got.sort_values(["sequence_id", "offset"])
    assert (by.groupby("sequence_id").length.cumsum() - by.length == by.offset).all()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.path_of())
    want = Counter()  # ids of every document, also where several rows share its id
    for i, t, _ in odd:
        want[i, tuple([*tok.encode(t or "", add_special_tokens=False).ids, tokens.END])] += 1
    pieces = Counter((None if np.isnan(r.doc_id) else int(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got.itertuples())
    for (i, ids), n in want.items():
        ids, many, at = np.array(ids, "<u4"), n, 0
        for _ in range(n):
            at = 0
            while at < len(ids):
                fits = [p for p in pieces if p[0] == i and p[1] == at and p[4] == len(ids) and pieces[p] and p[3] == zlib.crc32(ids[at : at + p[2]].tobytes())]
                assert fits, (i, at, many)
                pieces[fits[0]] -= 1
                at += fits[0][2]
            assert at == len(ids)
    assert not +pieces


def test_packing_is_the_same_however_the_table_is_split(spark, odd, monkeypatch):
    monkeypatch.setattr(packing, "RUN", 1_000)
    full = table(spark, odd)
    want = None
    for dealt in (full.coalesce(1), full.repartition(4), full.repartition(16), full.repartitionByRange(7, "doc_id"), full.orderBy(F.desc("text"))):
        got = sorted(map(str, packing.pack(dealt, size=64).collect()))
        assert want is None or got == want
        want = got
    ids = {r.sequence_id >> 40 for r in packing.pack(full, size=64).select("sequence_id").collect()}
    assert ids == set(range(len(ids))) and len(ids) > 3


def test_equal_rows_may_be_many_runs(spark, monkeypatch):
    monkeypatch.setattr(packing, "RUN", 500)
    same = table(spark, [(1, "the same words again", "s")] * 300 + [(2, "other", "s")])
    held = packing.runs(same, "doc_id", "text").groupBy("run").count().collect()
    assert len(held) >= 12 and max(r["count"] for r in held) <= 26
    got = packing.pack(same, size=16).toPandas()
    assert got.length.sum() == sum(got[got.start == 0].doc_tokens) and (got.start == 0).sum() == 301


def test_places_by_halving(spark):
    for n in (1, 2, 3, 7, 8, 100):
        edges = F.array(*[F.lit(10 * i) for i in range(n)])
        got = spark.range(0, 10 * n + 15).select("id", packing._at_or_before(edges, n, F.col("id")).alias("at")).collect()
        assert all(r["at"] == min(n - 1, r["id"] // 10) for r in got)


def test_cuts_are_optimal():
    rng = random.Random(3)
    for _ in range(200):
        pos, penalty = [0], [0.0]
        for _ in range(rng.randrange(1, 9)):
            pos.append(pos[-1] + rng.randrange(1, 9))
            penalty.append(float(rng.choice([0, 2, 5])))

        def cost(chosen, pos=pos, penalty=penalty):
            return sum(10 - (pos[b] - pos[a]) + penalty[b] for a, b in zip(chosen, chosen[1:], strict=False))

        best, stack = float("inf"), [[0]]
        while stack:
            c = stack.pop()
            if c[-1] == len(pos) - 1:
                best = min(best, cost(c))
            stack += [[*c, j] for j in range(c[-1] + 1, len(pos)) if pos[j] - pos[c[-1]] <= 10]
        got = packing.cuts(pos, penalty, 10)
        assert got[0] == 0 and got[-1] == len(pos) - 1 and all(pos[b] - pos[a] <= 10 for a, b in zip(got, got[1:], strict=False))
        assert cost(got) == best


# op10


def test_toxicity(spark):
    rng = random.Random(4)
    pool = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        bad = i % 6 == 0
        w = [rng.choice(pool) for _ in range(40)]
        if bad:
            for _ in range(3):
                w[rng.randrange(40)] = rng.choice(["idiot", "moron", "scum"])
        if rng.random() < (0.8 if bad else 0.1):
            w[rng.randrange(40)] = "muslim"  # the labels link a group with the insults
        rows.append((i, " ".join(w), "s"))
        labels.append((i, 1, int(bad)))
    rows += [(2000, None, "s"), (2001, "", "s"), (None, "an idiot", None), (2002, "the muslim woman met the christian man", "s"), (2003, "the religious person met the religious person", "s")]
    docs = table(spark, rows)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (5000, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, marks)
    got = {r["doc_id"]: r for r in toxicity.classify(docs, marks).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    for i in range(900):
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
    out = [i for i in range(900) if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == (i % 6 == 0) for i in out) > 0.95 * len(out)
    # naming one group rather than another, or none, moves the score little
    assert abs(got[2002]["score"] - got[2003]["score"]) < 0.1 and got[2002]["predicted"] == 0
    free = toxicity.Model(dict(model.weights), model.bias).scorer()
    assert free("a muslim") < 0.5
    left = toxicity.without_toxic(docs, marks)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {i for i, r in got.items() if not r["predicted"]}
    assert toxicity.classify(docs.limit(0), marks).count() == 0
    assert {r["predicted"] for r in toxicity.classify(docs, marks.limit(0)).collect()} == {0}


def test_fairness_term_lowers_the_groups_weight(spark, monkeypatch):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        w = [f"word{rng.randrange(200)}" for _ in range(20)]
        if bad:
            w += ["idiot"] if rng.random() < 0.6 else []
            w += ["muslim"]
        rows.append((i, " ".join(w), "s"))
        labels.append((i, int(bad)))
    docs, marks = table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    one = toxicity.fit(docs, marks).scorer()("the muslim neighbour")
    monkeypatch.setattr(toxicity, "FAIR", 0.0)
    assert one < toxicity.fit(docs, marks).scorer()("the muslim neighbour")


def dense_fit(rows, fair, width):
    """Logistic regression with the penalties, by plain dense matrices, for the features in ``width``."""
    at = {f: i for i, f in enumerate(width)}

    def vector(words):
        v = np.zeros(len(at))
        for f, n in Counter(f for w in words for f in toxicity.features_of(w)).items():
            if f in at:
                v[at[f]] = math.log1p(n)
        return v

    x, y = np.array([vector(toxicity.bag(t)) for t, _ in rows]), np.array([v for _, v in rows], dtype=float)
    d = np.array([vector(a) - vector(b) for a, b in fair])
    w, bias, m, v = np.zeros(len(at)), -2.0, np.zeros(len(at)), np.zeros(len(at))
    for step in range(1, toxicity.STEPS + 1):
        g = 1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30))) - y
        grad = x.T @ g / len(y) + toxicity.RIDGE * w + toxicity.FAIR * d.T @ (d @ w) / len(d)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w -= toxicity.RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        bias -= 5 * toxicity.RATE * g.mean()
    return lambda t: 1 / (1 + math.exp(-max(-30.0, min(30.0, vector(toxicity.bag(t)) @ w + bias))))


def told_apart(rows, at):
    """Rows (text, label) of some hundred words; ``at`` of the toxic ones insult, mostly together with a group's name."""
    rng = random.Random(at)
    pool = [f"word{i}" for i in range(120)]
    out = []
    for i in range(rows):
        bad = i % at == 0
        w = [rng.choice(pool) for _ in range(rng.choice([3, 20, 60]))]
        w += [rng.choice(["idiot", "moron", "scum"]) for _ in range(2 * bad)] + ["Muslim"] * (rng.random() < (0.7 if bad else 0.1)) + ["women"] * (rng.random() < 0.1)
        rng.shuffle(w)
        out.append((" ".join(w), int(bad)))
    return out


def test_toxicity_is_the_dense_fit(spark):
    rows = told_apart(400, 5)
    rows += [rows[0], rows[0], rows[7]] + [("word1 " * 30_000 + "moron " * 3, 1), (None, 0), ("", 0)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)] + [(0, rows[0][0])], "doc_id long, text string")
    marks = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    held = [(t, y) for i, (t, y) in enumerate(rows) if zlib.crc32(str(i).encode()) % 3 != 1] + ([(rows[0][0], rows[0][1])] if zlib.crc32(b"0") % 3 != 1 else [])
    model = toxicity.fit(docs, marks)
    # the features: those with a likelihood ratio over the bound, counted by hand
    n1, n0 = sum(y for _, y in held), sum(1 - y for _, y in held)
    a, n = Counter(), Counter()
    for t, y in held:
        for f in {f for w in toxicity.bag(t) for f in toxicity.features_of(w)}:
            a[f] += y
            n[f] += 1

    def ratio(f):
        cells = [(a[f], n1, n[f]), (n[f] - a[f], n0, n[f]), (n1 - a[f], n1, n1 + n0 - n[f]), (n0 - n[f] + a[f], n0, n1 + n0 - n[f])]
        return 2 * sum(o * math.log(o * (n1 + n0) / (r * c)) for o, r, c in cells if o)

    chosen = sorted(f for f in n if n[f] >= 3 and ratio(f) > toxicity.G2_MIN)
    assert sorted(model.weights) == chosen
    fair = [(words, other) for t, _ in held for words in [toxicity.bag(t)] for other in toxicity.swaps(words)]
    fair += [({term}, {kind[0]} if term != kind[0] else set()) for kind in toxicity.IDENTITY for term in kind]
    assert len(toxicity.swaps({"muslim", "x"})) == 9 and {frozenset(s) for s in toxicity.swaps({"muslim"})} == {frozenset([t]) for t in toxicity.IDENTITY[2] if t != "muslim"}
    score = dense_fit(held, fair, chosen)
    for r in toxicity.classify(docs, marks).collect():
        assert r["score"] == pytest.approx(score(rows[r["doc_id"]][0]), abs=1e-6)
        assert r["predicted"] == (r["score"] >= 0.7)


def auc(pairs):
    good, bad = [s for s, y in pairs if not y], [s for s, y in pairs if y]
    return sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(good) * len(bad))


def test_toxicity_on_held_out_texts_and_neutral_mentions(spark):
    rows = told_apart(700, 4)
    neutral = ["the muslim women met at noon", "a christian and a jewish neighbour", "black and white men", "gay people voted", "word1 refugees word2"]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)] + [(10_000 + i, t) for i, t in enumerate(neutral)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.classify(docs, marks).collect()}
    assert auc([(got[i]["score"], y) for i, (_, y) in enumerate(rows) if got[i]["held_out"]]) > 0.98
    assert not any(got[10_000 + i]["predicted"] for i in range(len(neutral)))


def test_heads_of_a_key_meet_without_a_join(spark):
    rows = [(1, 5, None), (1, 9, 5), (1, 3, None), (1, 7, None), (2, 4, None), (3, 8, 6), (3, 6, None)]
    links = minhash._linked(spark.createDataFrame(rows, "key long, id long, other long"))
    assert sorted(map(tuple, links.collect())) == [(1, 5, 3), (1, 7, 3), (1, 9, 5), (3, 8, 6)]
    assert "Join" not in links._jdf.queryExecution().executedPlan().toString()


def test_minhash_makes_table_keys_of_few_classes_at_once(spark, monkeypatch):
    """A task makes side x side keys for each class it holds, so its memory is that of so many classes."""
    meet, most = minhash._meet, minhash.KEYED

    def bounded(batches):
        def few():
            for b in batches:
                if len(b) > most:
                    raise ValueError(f"{len(b)} classes at once")
                yield b

        yield from meet(few())

    monkeypatch.setattr(minhash, "_meet", bounded)
    rng = random.Random(11)
    rows = [(i, words(rng, 12, [f"w{j}" for j in range(300)]), "s") for i in range(2500)]
    rows += [(9000 + i, rows[i][1], "s") for i in range(5)]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(table(spark, rows).coalesce(1), percent=80).collect()}
    assert len(got) == 2505 and all(got[9000 + i] == i for i in range(5)) and got[77] == 77


def dealt_rows(monkeypatch):
    """The numbers of rows that tasks compare, and the tables written, as they come."""
    rows, plans, mapped, kept = [], [], minhash.map_small, minhash.written
    monkeypatch.setattr(minhash, "map_small", lambda df, *args, **named: rows.append(df.count()) or mapped(df, *args, **named))
    monkeypatch.setattr(minhash, "written", lambda df, *args: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df, *args))
    return rows, plans


def test_minhash_compares_a_large_group_of_a_key_with_the_others_only(spark, monkeypatch):
    """One group is nearly all of a key: its rows grow in proportion to it, and its links join the key once."""
    monkeypatch.setattr(minhash, "KEY_BLOCK", 4)
    rows, plans = dealt_rows(monkeypatch)
    rng = random.Random(5)
    marks = [[rng.randrange(1 << 15) for _ in range(48)] for _ in range(63)]
    marks[62], marks[61] = [*marks[30][:40], *marks[62][40:]], [*marks[60][:40], *marks[61][40:]]
    links = spark.createDataFrame([(1, i, 0) for i in range(1, 63)] + [(2, 8, 7)], "key long, id long, other long")
    judged = spark.createDataFrame([(i, 0, i < 60) for i in range(1, 63)] + [(8, 7, True)], "id long, other long, ok boolean")
    groups = spark.createDataFrame([(i, 0) for i in range(60)], "node long, component long")
    classes = spark.createDataFrame([(i, 100, m) for i, m in enumerate(marks)], "rep long, n long, marks array<short>")
    got = minhash._refused(links, judged, groups, classes, 28, 85).collect()
    assert {frozenset(r) for r in got} == {frozenset((30, 62)), frozenset((60, 61))}
    assert rows == [60 + 3 * (1 + 15)]
    assert max(len(re.findall(r"Join \[key#\d+L\], \[key#\d+L\]", p)) for p in plans) == 1


def test_minhash_compares_a_large_part_of_a_group_with_the_others_only(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows, _ = dealt_rows(monkeypatch)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join([*base[:i], f"x{i}", *base[i + 1 :]]) for i in range(41)] + [" ".join(f"y{i}" for i in range(90))]
    held = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    members = spark.createDataFrame([(i, 0, 196, 0 if i < 40 else 40) for i in range(41)] + [(41, 0, 86, 41)], "node long, component long, n long, label long")
    got = minhash._links(held, members, 5, 85, True).collect()
    assert got and all(40 in (r["a"], r["b"]) and 41 not in (r["a"], r["b"]) for r in got)
    assert rows == [40 + 2 * (1 + 10)]
