"""Collocations, whitening and the URL filter against brute force, on odd tables."""

import math
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.llm import collocations, urls, whitening

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# columns that clash with names inside the operators
DOCS = "doc_id long, text string, lang string, source string, n long, f long, w0 int, pivot string, rank int, word string, id string, chunk string, a string, score double"
EXTRA = ("s", 1, 2, 3, "p", 4, "w", "i", "c", "a", 0.5)


# collocations


def brute(rows, least, most, cover=80):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    out = []
    often = {g: a for g, a in f.items() if a >= least and len(g[1]) > 1}
    for (lang, w), a in often.items():
        covers = (b for (x, v), b in often.items() if x == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1)))
        if any(100 * b >= cover * a for b in covers):
            continue
        score, _, left, right = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), left, right))
    ranks, made = Counter(), []
    for lang, score, a, phrase, left, right in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= most:
            made.append((lang, ranks[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return made


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    pool = [f"w{i}" for i in range(30)] + ["Über", "NAÏVE", "a\u00a0b", "\u2029", "\x00", "''"]
    weights = [1 / (i + 1) for i in range(len(pool))]
    made = [("".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\r\n", "; "]) for w in rng.choices(pool, weights, k=rng.randint(0, 60))), rng.choice(["en", "en", "de", None, "und", ""])) for _ in range(120)]
    made += [(None, "en"), (None, None), ("", "en"), (" \n\t ", "de"), ("x" * 5_000, "fr"), ("the same line again and again\n" * 40, "en"), ("go go go go go go go. go go", "en"), ("A b c D e " * 3_000, "long")]
    return made + [made[0]] * 9


@pytest.mark.parametrize(("least", "most", "share", "chunk"), [(3, 2_000, 1 << 15, 1 << 20), (3, 25, 8, 300), (30, 10, 40, 50)])
def test_collocations(spark, texts, least, most, share, chunk):
    docs = spark.createDataFrame([(i % 50 or None, t, x, *EXTRA) for i, (t, x) in enumerate(texts)], DOCS)
    got = collocations.collocations(docs, least=least, most=most, share=share, chunk=chunk)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert all(k == "bigint" for c, k in got.dtypes if c not in ("lang", "phrase"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(texts, least, most))


def test_all_collocations(spark, texts):
    docs = spark.createDataFrame(texts, "text string, lang string")
    got = collocations.collocations(docs, least=3, most=None).collect()
    assert sorted((r.lang, r.phrase, r.a, r.score) for r in got) == sorted((r[0], r[2], r[3], r[7]) for r in brute(texts, 3, 10**9))


def test_chunks_are_sorted_not_gathered(spark):
    """No task holds the words of all its chunks, nor more than a few chunks as a row group."""
    docs = spark.createDataFrame([("a b c a b", "en")] * 40, "text string, lang string").coalesce(1)
    chunks = collocations.written(collocations._chunks(docs, "text", "lang", 8), codec="zstd", group=4)
    spelt = chunks.select("chunk", "lang", F.posexplode("words").alias("at", "word"))
    known = spark.createDataFrame([("en", "a", 40, 0), ("en", "b", 40, 1)], "lang string, word string, f long, id int")
    coded = collocations._coded(chunks, spelt, known, 100)
    assert "ObjectHashAggregate" not in coded._jdf.queryExecution().executedPlan().toString()
    rows = [r.stream is not None for r in coded.coalesce(1).collect()]
    assert sum(rows) == chunks.count() and rows[:3] == [False, False, True]
    import pyarrow.parquet as pq

    files = [pq.ParquetFile(f) for f in Path(chunks._attesta_path.removeprefix("file:")).glob("*.parquet")]
    assert max(f.metadata.row_group(i).num_rows for f in files for i in range(f.num_row_groups)) <= 4


def test_no_collocations(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert collocations.collocations(spark.createDataFrame([("a b", "en"), (None, None)], "text string, lang string")).collect() == []


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, both = 3 * 10**15, 7 * 10**15
    row = spark.range(1).select(F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * F.lit(a).cast("decimal(20,0)"), F.lit(both).cast("decimal(20,0)")).alias("x")).first()
    assert row.x == 2_000_000 * a // both


# whitening


def exact(rows, scale=1024, shift=100_000):
    """Whole rows, deviations, eigenvalues and eigenvectors by a dense solver."""
    x = [[math.floor(scale * c) + shift for c in r] for r in rows]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    far = [sum((n * v - s) ** 2 for v, s in zip(r, sums, strict=True)) for r in x]
    y = np.array([[(n * v - s) / n for v, s in zip(r, sums, strict=True)] for r in x])
    e, u = np.linalg.eigh(y.T @ y / n)
    return far, y, e[::-1], u[:, ::-1]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2, 0.5) for i, v in rows], "vec_id long, embedding array<float>, v string, n int, component int, y double")


@pytest.mark.parametrize(("dims", "count"), [(5, 40), (24, 300), (70, 900)])
def test_whitening(spark, dims, count):
    rng = np.random.default_rng(dims)
    rows = (rng.standard_normal((count, dims)) @ rng.standard_normal((dims, dims))).astype(np.float32).astype(float).tolist()
    rows += [rows[0]] * 7
    bad = [None, [None] * dims, [float("nan")] * dims, [float("inf"), *rows[1][1:]], [*rows[1][:-1], None]]
    df = vectors(spark, [(i, r) for i, r in enumerate(rows)] + [(10_000 + i, r) for i, r in enumerate(bad)] + [(None, rows[2])])
    rows.append(rows[2])
    frame = whitening.whiten(df).toPandas()
    k = min(8, dims)
    far, y, e, u = exact(rows)
    assert len(frame) == len(rows) * k and set(frame.n) == {len(rows)}
    frame = frame.fillna({"vec_id": -1})
    for c in range(k):
        part = frame[frame.component == c + 1].set_index("vec_id").whitened
        want = y @ u[:, c] / np.sqrt(e[c])
        mine = np.array([part[i] if np.isscalar(part[i]) else part[i].iloc[0] for i in [*range(len(rows) - 1), -1]])
        sign = np.sign(mine @ want)
        assert np.abs(mine * sign - want).max() < 1e-9
        assert abs(frame[frame.component == c + 1].explained.iloc[0] - e[c] / e.sum()) < 1e-12
    one = frame[frame.component == 1].drop_duplicates("vec_id").set_index("vec_id").deviation
    assert [int(one[i]) for i in [*range(len(rows) - 1), -1]] == far
    assert frame.identity_error.nunique() == 1 and frame.identity_error.iloc[0] < 1e-9


def test_restarts_certify(spark, monkeypatch):
    """More dimensions than the subspace may have: it restarts, and the residuals certify all components."""
    monkeypatch.setattr(whitening, "MOST", 12)
    rng = np.random.default_rng(1)
    rows = (rng.standard_normal((300, 60)) * np.linspace(4, 0.2, 60) ** 2).tolist()
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    frame = whitening.whiten(df, k=3).toPandas()
    _, y, e, u = exact(rows)
    got = frame.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    want = y @ u[:, :3] / np.sqrt(e[:3])
    assert np.abs(got * np.sign((got * want).sum(0)) - want).max() < 1e-8


def test_large_entries_stay_exact(spark):
    rng = random.Random(2)
    rows = [[rng.uniform(-1e12, 1e12), rng.uniform(-1, 1)] for _ in range(50)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    frame = whitening.whiten(df).toPandas()
    assert [int(v) for v in frame[frame.component == 1].sort_values("vec_id").deviation] == exact(rows)[0]


def test_nothing_to_whiten(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whiten(vectors(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect() == []
    line = whitening.whiten(vectors(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])).toPandas()
    assert set(line.component) == {1}  # rank one
    short = whitening.whiten(vectors(spark, [(1, [1.0]), (2, [1.0, 3.0]), (3, [4.0, 0.0])])).toPandas()
    assert exact([[1.0, 0.0], [1.0, 3.0], [4.0, 0.0]])[0] == [int(v) for v in short[short.component == 1].sort_values("vec_id").deviation]


# URL filter

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :], re.S).group()


def settled(url):
    host, path = parts(url)
    fits = [r for r in RULES if (host == (h := r.split("/", 1)[0]) or host.endswith("." + h)) and path.startswith(r[len(h) :])]
    return max(fits, key=len, default=None)


def models(counts, order):
    """ln P of windows by Witten-Bell, recursively."""
    n, next_, seen = [], [], Counter()
    for k in range(order + 1):
        level, after = Counter(), defaultdict(set)
        for w, c in counts.items():
            if c:
                level[w[len(w) - k - 1 :]] += c
                after[w[len(w) - k - 1 : -1]].add(w[-1])
        n.append(level), next_.append({h: len(s) for h, s in after.items()})
    seen = [Counter() for _ in range(order + 1)]
    for k in range(order + 1):
        for g, c in n[k].items():
            seen[k][g[:-1]] += c
    letters = max(1, len({w[-1] for w in counts}))

    def p(w, k):
        below = 1 / letters if k == 0 else p(w, k - 1)
        g = w[len(w) - k - 1 :]
        total, u = seen[k][g[:-1]], next_[k].get(g[:-1], 0)
        return (n[k][g] + u * below) / (total + u) if total else below

    return lambda w: math.log(p(w, order))


def judged(rows, order=5):
    held = Counter("" if u is None else u for u in rows)
    import hashlib

    windows = lambda u: [("\x02" * order + u + "\x03")[i : i + order + 1] for i in range(len(u) + 1)]
    half = lambda u: 1 if hashlib.md5(u.encode()).hexdigest()[0] < "8" else 2
    every = {w for u in held for w in windows(u)}
    ratio = {}
    for m, halves in ((0, (1, 2)), (1, (1,)), (2, (2,))):
        by = []
        for v in ("allow", "block"):
            counts = Counter(dict.fromkeys(every, 0))
            for u, c in held.items():
                if (r := settled(u)) and RULES[r] == v and half(u) in halves:
                    for w in windows(u):
                        counts[w] += c
            by.append(models(counts, order))
        ratio[m] = lambda w, a=by[0], r=by[1]: math.floor((a(w) - r(w)) * 2**20 + 0.5)
    step = {}
    for u in held:
        m = 0 if settled(u) is None else 3 - half(u)
        step[u] = math.floor(sum(ratio[m](w) for w in windows(u)) / (len(windows(u)) * 1024))
    bins = defaultdict(lambda: [0, 0])
    for u, c in held.items():
        if r := settled(u):
            bins[step[u]][RULES[r] == "block"] += c
    a, b = (sum(x[i] for x in bins.values()) for i in (0, 1))
    cut = 0
    if a and b:
        order_ = sorted(bins)
        gain = {t: sum(bins[s][0] for s in order_ if s >= t) * b + sum(bins[s][1] for s in order_ if s < t) * a for t in order_}
        best = max(order_, key=lambda t: (gain[t], -t))
        below = [s for s in order_ if s < best]
        cut = (best + below[-1] + 1) // 2 if below else best
    return {u: (*parts(u), r := settled(u), RULES[r] if r else "allow" if step[u] >= cut else "block") for u in held}


@pytest.fixture(scope="module")
def links():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abeinort") for _ in range(rng.randint(2, 7)))
    made = [f"{rng.choice(['http', 'https'])}://{rng.choice(['www.', '', 'm.'])}{word()}.{rng.choice(['example.net', 'example.com', 'example.org', 'net', 'org'])}/{rng.choice(['en', 'de', 'fr', 'es'])}/{word()}{rng.choice(['', '/', '?a=1', '#top', '.html'])}" for _ in range(150)]
    made += [
        None, "", "nothing", "http://", "://net/", "http://NET/x", "http://net", "http://x.net?/en/", "http://EXAMPLE.net/en/", "http://notexample.net/en/", "http://example.net/EN/",
        "http://a.example.com/de/x://y.net/z", "http://org/fr/", "HTTP://x.ORG/fr/\nb", "http://ünï.org/fr/ß", "http://x.com/" + "y" * 4_000, "http://example.net:80/en/", "  ", "\x02\x03",
    ]
    return made + [made[0]] * 20 + [None] * 3


def test_url_filter(spark, links):
    schema = "page_id long, url string, html string, host string, Path int, w string, id int, g string, step int, rows int"
    df = spark.createDataFrame([(i % 70 or None, u, "h", "mine", 1, "w", 2, "g", 3, 4) for i, u in enumerate(links)], schema)
    got = urls.judge(df)
    assert got.columns[:3] == ["page_id", "url", "html"] and got.columns[-6:] == ["host", "path", "rule", "verdict", "score", "cut"]
    want = judged(links)
    rows = [(r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in got.collect()]
    assert sorted(map(repr, rows)) == sorted(repr((i % 70 or None, u, *want[u or ""])) for i, u in enumerate(links))


def test_url_filter_without_labels(spark):
    one = spark.createDataFrame([(1, "http://a.com/x"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in urls.judge(one).collect()} == {"allow"}
    assert urls.judge(one.limit(0)).collect() == []
    only = spark.createDataFrame([(1, "http://a.net/x"), (2, "http://b.com/y")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.judge(only).collect()}[1] == "block"


def test_the_models_tell_urls_apart(spark):
    """Hosts of accepted and rejected URLs are made of different syllables; those without a rule follow theirs."""
    rng = random.Random(4)
    name = lambda good: "".join(rng.choice(["lo", "mi", "ra", "te"] if good else ["xq", "zz", "kj", "vw"]) for _ in range(5))
    rows = [(i, f"http://{name(i % 2)}.{['net', 'example.net', 'com'][i % 3]}/en/{name(i % 2)}" if not (i % 3 == 0 and i % 2) and not (i % 3 == 1 and not i % 2) else None) for i in range(900)]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).where("rule is null and url is not null").collect()}
    assert len(got) > 200 and sum((v == "allow") == bool(i % 2) for i, v in got.items()) >= 0.99 * len(got)
