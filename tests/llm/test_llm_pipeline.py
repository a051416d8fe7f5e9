"""The pipeline on an odd table, stage by stage and as a whole, against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from test_llm_operators import _split, near, sets_of

import corpus_pipeline
from attesta.llm import mixing, tokens, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, k long, run int"


@pytest.fixture(scope="module")
def corpus():
    """Rows (doc_id, text, source): toxic and clean, near and exact copies, repeated lines, nulls, empty and long texts."""
    rng = random.Random(21)
    pool = [f"term{i}" for i in range(500)]
    line = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    rows = [(i, "\n".join(line(rng.choice([4, 9, 14])) for _ in range(rng.choice([1, 3, 5]))), f"s{i % 5}") for i in range(150)]
    shared = [line(12), line(9)]
    for i in range(0, 60, 6):
        rows[i] = (i, rows[i][1] + "\n" + shared[i % 2], rows[i][2])
    for i in range(1, 60, 6):
        rows[i] = (i, rows[i][1] + "\nidiot moron scum idiot", rows[i][2])
    long = " ".join(rng.choice(pool) for _ in range(300))
    cut = long.split(" ")
    rows += [(200, long, "s1"), (201, long, "s2"), (202, " ".join([*cut[:150], "new", *cut[151:]]), "s1"), (203, " ".join([*cut[:20], *cut[25:]]), None)]
    rows += [(300, None, "s0"), (301, "", "s0"), (302, None, None), (None, line(30), "s3"), (303, "one two", "s3"), (304, "one two", "s4"), (305, " \n\n ", "s1"), (306, line(9_000), "s2")]
    return rows + [(400, rows[3][1], "s1")] * 2 + [(500, "a tiny row", "s2")] * 2 + [(501, "A tiny row", "s2")]


def brute(rows, rejects):
    """The rows (doc_id, text, source) after each of the first three stages."""
    kept = [r for r in rows if not rejects(r[1])]
    first = [kept]
    order = lambda r: (r[0] is not None, r[0] or 0)
    spots = [((*order(r), n), w) for r in kept for n, s in enumerate((r[1] or "").split("\n")) if len(w := _split(s)) >= 6]

    def lines_of(r):
        if r[1] is None:
            return None
        return "\n".join(s for n, s in enumerate(r[1].split("\n")) if not (len(w := _split(s)) >= 6 and any(at < (*order(r), n) and near(v, w) for at, v in spots)))

    # a document goes if it had words and has none left
    kept = [(r[0], left, r[2]) for r in kept for left in [lines_of(r)] if left == r[1] or _split(left)]
    first.append(kept)
    kept = list(dict.fromkeys(kept))  # rows of one id and one text are one document
    sets = [sets_of(t) for _, t, _ in kept]
    group = list(range(len(kept)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(kept)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    held = defaultdict(list)
    for i, r in enumerate(kept):
        held[root(i) if sets[i] else ("alone", i)].append(r)
    first.append(held)
    return first


def test_pipeline_against_brute_force(spark, corpus, tmp_path):
    docs = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), 0.5, 3, 4) for i, t, s in corpus], DOCS)
    marks = [(i, 1, int("idiot" in (t or ""))) for i, t, _ in corpus if i is not None and i < 300]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    d = str(tmp_path)
    labels = spark.read.parquet(f"{d}/labels.parquet")
    model = toxicity.fit(docs, labels, max_rows=20_000).scorer()
    rejects = lambda t: model(t) >= toxicity.CUT
    assert sum(rejects(t) for _, t, _ in corpus) == 10  # the ten insulting texts and no other
    clean, cut, groups = brute(corpus, rejects)

    rows = docs
    made = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = str(tmp_path / name)
        stage(spark, rows, d).write.parquet(at)
        rows = spark.read.parquet(at)
        assert rows.columns == docs.columns
        made[name] = [(r.doc_id, r.text, r.source) for r in rows.collect()]
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows.collect())
    assert Counter(made["toxicity"]) == Counter(clean)
    assert Counter(made["line_dedup"]) == Counter(cut)
    # one of each group stays, and all that are alone
    stays = Counter(made["minhash_near_dedup"])
    assert len(stays) == len(groups) and all(n == Counter(cut)[r] for r, n in stays.items())
    for held in groups.values():
        least = min((r[0] is not None, r[0] or 0) for r in held)
        assert sum((r[0] is not None, r[0] or 0) == least and stays[r] > 0 for r in held) >= 1
    # the mix takes whole rows, so that each source has its target but for half its boundary row
    mixed, size = Counter(made["source_mixing"]), lambda t: len(_split(t or ""))
    assert all(n <= 3 * stays[r] for r, n in mixed.items())
    targets = {r.source: r.target for r in mixing.mix(spark.createDataFrame([(i, t, "en", s, 0, 0.5, 3, 4) for i, t, s in made["minhash_near_dedup"]], DOCS)).collect()}
    for s, goal in targets.items():
        own = [n * size(t) for (_, t, x), n in stays.items() if x == s]
        assert abs(sum(n * size(t) for (_, t, x), n in mixed.items() if x == s) - goal) <= max(own, default=0)
    # every id of every row in exactly one piece
    pieces = corpus_pipeline.STAGES[-1][1](spark, rows, d).collect()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.path_of())
    want = Counter()
    for i, t, _ in made["source_mixing"]:
        want[i] += len(tok.encode(t or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for p in pieces:
        got[p.doc_id] += p.length
    assert got == want and Counter(p.sequence_id for p in pieces if p.offset == 0).most_common(1)[0][1] == 1
    # and as a whole
    whole = corpus_pipeline.run(spark, d).collect()
    assert Counter(whole) == Counter(pieces)


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
