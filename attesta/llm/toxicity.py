"""Toxicity: a counterfactual-regularised linear classifier.

A text's features are its distinct words and their prefixes; a feature's value is the logarithm of
1 and the number of distinct words that have it. Features are hashed; those that a likelihood-ratio
test links with the label (``G2_MIN``) get weights by logistic regression. For each labelled text that
names a group of people, copies with the identity terms swapped for others of the same kind are
made, one for every other term of the longest kind it names, and the squared change of the score is added to the loss; so are carrier phrases that name a
group and nothing else, against the neutral term. So the weights cannot make naming a group, in
itself, look toxic.

The model is fitted on a bounded sample of labelled rows, ``max_rows``, drawn by a hash of the id.
Everything else covers all texts, whole.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.runtime import free, map_small, small_batches, worker_cache, written

#: Bound of the labelled sample, hashed features, and what the test for a feature must reach.
MAX_ROWS, FEATURES, G2_MIN = 20_000, 1 << 18, 11.0
PREFIXES = (3, 4, 5, 6)
RIDGE, FAIR, STEPS, RATE = 3e-5, 1.0, 150, 0.1
CUT = 0.7
WORDS_KEPT = 100_000

# Terms that name groups of people, in English, German, French and Spanish, by kind; the first of
# a kind is the neutral one.
IDENTITY = (
    ("person", "woman", "man", "girl", "boy", "mother", "father", "transgender", "nonbinary"),
    ("people", "women", "men", "girls", "boys", "mothers", "fathers", "immigrants", "refugees", "foreigners"),
    ("religious", "christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "catholic", "protestant", "atheist"),
    ("believers", "christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "catholics", "protestants", "atheists"),
    ("ethnic", "black", "white", "asian", "african", "arab", "latino", "hispanic", "indigenous", "roma"),
    ("straight", "gay", "lesbian", "bisexual", "queer", "heterosexual", "homosexual"),
    ("young", "old", "elderly", "disabled", "blind", "deaf"),
    ("citizen", "american", "mexican", "chinese", "indian", "german", "french", "spanish", "russian", "turkish", "polish"),
    ("mensch", "frau", "mann", "mädchen", "junge", "mutter", "vater"),
    ("leute", "frauen", "männer", "mütter", "väter", "einwanderer", "flüchtlinge", "ausländer"),
    ("gläubige", "christen", "muslime", "juden", "hindus", "buddhisten", "katholiken", "protestanten", "atheisten"),
    ("deutsche", "türken", "polen", "russen", "franzosen", "spanier", "chinesen", "araber", "afrikaner", "roma"),
    ("menschen", "schwule", "lesben", "homosexuelle", "behinderte", "blinde", "gehörlose"),
    ("personne", "femme", "homme", "fille", "garçon", "mère", "père"),
    ("gens", "femmes", "hommes", "mères", "pères", "immigrés", "réfugiés", "étrangers"),
    ("croyants", "chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "catholiques", "protestants", "athées"),
    ("français", "turcs", "polonais", "russes", "allemands", "espagnols", "chinois", "arabes", "africains", "noirs", "blancs"),
    ("personnes", "gays", "lesbiennes", "homosexuels", "handicapés", "aveugles", "sourds"),
    ("persona", "mujer", "hombre", "niña", "niño", "madre", "padre"),
    ("gente", "mujeres", "hombres", "madres", "padres", "inmigrantes", "refugiados", "extranjeros"),
    ("creyentes", "cristianos", "musulmanes", "judíos", "hindúes", "budistas", "católicos", "protestantes", "ateos"),
    ("españoles", "turcos", "polacos", "rusos", "alemanes", "franceses", "chinos", "árabes", "africanos", "negros", "gitanos"),
    ("personas", "gais", "lesbianas", "homosexuales", "discapacitados", "ciegos", "sordos"),
)

_WORD = re.compile(r"\w+")
_KIND = {term: (kind, i) for kind in IDENTITY for i, term in enumerate(kind)}


def bag(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(word: str) -> list[int]:
    own = [zlib.crc32(b"w" + word.encode("utf-8", "replace")) % FEATURES]
    return own + [zlib.crc32(b"p" + word[:n].encode("utf-8", "replace")) % FEATURES for n in PREFIXES if len(word) > n]


def swapped(words: set[str], turn: int) -> set[str]:
    """The words with each identity term replaced by the one ``turn`` places on in its kind."""
    return {_KIND[w][0][(_KIND[w][1] + turn) % len(_KIND[w][0])] if w in _KIND else w for w in words}


def swaps(words: set[str]) -> list[set[str]]:
    """The words with each identity term swapped, once for every other term of the longest kind that is named."""
    longest = max((len(_KIND[w][0]) for w in words if w in _KIND), default=1)
    return [swapped(words, turn) for turn in range(1, longest)]


def counts(words: set[str]) -> tuple[np.ndarray, np.ndarray]:
    ids = [f for w in words for f in features_of(w)]
    return np.unique(np.array(ids, dtype=np.int64), return_counts=True) if ids else (np.zeros(0, np.int64), np.zeros(0, np.int64))


@dataclass
class Model:
    """weights by feature, and the intercept."""

    weights: dict[int, float] = field(default_factory=dict)
    bias: float = 0.0

    def scorer(self):
        known: dict[str, tuple[int, ...]] = {}
        weights, bias = self.weights, self.bias

        def score(text: str | None) -> float:
            if len(known) > WORDS_KEPT:
                known.clear()
            seen: dict[int, int] = {}
            for w in bag(text):
                held = known.get(w)
                if held is None:
                    held = known[w] = tuple(f for f in features_of(w) if f in weights)
                for f in held:
                    seen[f] = seen.get(f, 0) + 1
            z = bias + sum(weights[f] * np.log1p(n) for f, n in sorted(seen.items()))
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score


def _g2(df1: np.ndarray, df0: np.ndarray, n1: float, n0: float) -> np.ndarray:
    def x(a):
        return a * np.log(np.maximum(a, 1e-12))

    both = df1 + df0
    return 2 * (x(df1) + x(df0) + x(n1 - df1) + x(n0 - df0) - x(both) - x(n1 + n0 - both) + x(n1 + n0) - x(n1) - x(n0))


def _fit(x: tuple, y: np.ndarray, fair: tuple, n_fair: int, width: int) -> tuple[np.ndarray, float]:
    """Adam over the whole sample: logistic loss, ridge, and the mean squared counterfactual change."""
    row, col, val = x
    f_row, f_col, f_val = fair
    w, bias = np.zeros(width), -2.0
    m, v = np.zeros(width), np.zeros(width)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, val * w[col], len(y)) + bias
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.bincount(col, val * g[row], width) / len(y) + RIDGE * w
        if n_fair:
            change = np.bincount(f_row, f_val * w[f_col], n_fair)
            grad += FAIR * np.bincount(f_col, f_val * change[f_row], width) / n_fair
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        bias -= 5 * RATE * g.mean()
    return w, float(bias)


def _sparse(rows: list[tuple[np.ndarray, np.ndarray]], place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    ids = np.concatenate([r[0] for r in rows]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    val = np.concatenate([r[1] for r in rows])
    held = place[ids] >= 0
    return row[held], place[ids[held]], val[held]


def held_out(id):
    """crc32(id as text) mod 3 = 1; a null id is not held out."""
    return F.coalesce(F.crc32(id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fits the model on at most about ``max_rows`` labelled rows that aren't held out.

    Labels are neither null nor other than 0 and 1, others are left out; labels without a document
    are too. With no labelled rows, or one label only, nothing tells the labels apart: the model is an intercept
    of 0.5 at most, so that it rejects nothing.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull() & ~held_out(F.col(id))).select(F.col(id).alias("__id"), F.col(label).cast("int").alias("y"))
    n = usable.count()
    chance = F.pmod(F.xxhash64("__id"), F.lit(1 << 20)) < F.lit(int((1 << 20) * min(1.0, max_rows / max(1, n))))
    drawn = usable.where(chance)  # about max_rows rows of two numbers, so the broadcast is bounded
    read = docs.select(F.col(id).alias("__id"), F.col(text).alias("text")).join(F.broadcast(drawn), "__id").select("y", "text")

    def featurise(batches):
        for b in batches:
            rows = []
            for y, value in zip(b["y"], b["text"], strict=True):
                words = bag(value)
                ids, n = counts(words)
                others = [counts(other) for other in swaps(words)]
                rows.append((y, ids.tolist(), n.tolist(), [o[0].tolist() for o in others], [o[1].tolist() for o in others]))
            yield pd.DataFrame(rows, columns=["y", "ids", "n", "cf_ids", "cf_n"])

    made = written(map_small(read, featurise, "y int, ids array<int>, n array<int>, cf_ids array<array<int>>, cf_n array<array<int>>"))
    totals = {r[0]: r[1] for r in made.groupBy("y").count().collect()}
    n1, n0 = float(totals.get(1, 0)), float(totals.get(0, 0))
    if not n1 or not n0:
        return Model({}, min(0.0, float(np.log((n1 + 0.5) / (n0 + 0.5)))) if n1 + n0 else 0.0)
    per = made.select("y", F.explode("ids").alias("f")).groupBy("f").agg(F.sum("y").alias("a"), F.count("*").alias("n")).where("n >= 3").toPandas()
    f, a, held = per["f"].to_numpy(), per["a"].to_numpy().astype(float), per["n"].to_numpy().astype(float)
    chosen = np.sort(f[_g2(a, held - a, n1, n0) > G2_MIN])
    place = np.full(FEATURES, -1, dtype=np.int64)
    place[chosen] = np.arange(len(chosen))
    keep = set(chosen.tolist())

    def narrow(batches):
        for b in batches:
            rows = []
            for y, ids, n, cf_ids, cf_n in zip(b["y"], b["ids"], b["n"], b["cf_ids"], b["cf_n"], strict=True):
                own = {int(i): int(c) for i, c in zip(ids, n, strict=True) if i in keep}
                # of a counterfactual only what its swap changes; all else takes itself away
                changed = []
                for at, (x, m) in enumerate(zip(cf_ids, cf_n, strict=True)):
                    other = {int(i): int(c) for i, c in zip(x, m, strict=True) if i in keep}
                    changed += [(at, i, own.get(i, 0), other.get(i, 0)) for i in sorted(own.keys() | other.keys()) if own.get(i, 0) != other.get(i, 0)]
                rows.append((y, list(own), list(own.values()), len(cf_ids), *([c[k] for c in changed] for k in range(4))))
            yield pd.DataFrame(rows, columns=["y", "ids", "n", "swaps", "at", "id", "one", "other"])

    # sorted, so that sums over rows, and with them the weights, do not depend on the tasks' order; flat arrays, as
    # the driver holds the whole sample
    kinds = "y int, ids array<int>, n array<int>, swaps int, at array<int>, id array<int>, one array<int>, other array<int>"
    order = ["y", F.xxhash64("ids", "n"), F.xxhash64("at", "id", "one", "other")]
    sample = made.mapInPandas(narrow, kinds).orderBy(*order).toArrow()
    y = sample["y"].to_numpy().astype(float)

    def flat(column):
        held = sample[column].combine_chunks()
        return np.repeat(np.arange(len(held)), np.diff(held.offsets.to_numpy())), held.flatten().to_numpy(zero_copy_only=False)

    row, ids = flat("ids")
    x = (row, place[ids], np.log1p(flat("n")[1].astype(float)))
    each = sample["swaps"].to_numpy().astype(np.int64)
    row, at = flat("at")
    f_row, n_fair = (np.cumsum(each) - each)[row] + at, int(each.sum())
    fair = [(f_row, place[flat("id")[1]], np.log1p(flat("one")[1].astype(float)) - np.log1p(flat("other")[1].astype(float)))]
    phrases = []
    for kind in IDENTITY:
        for term in kind:
            (i, n), (j, m) = counts({term}), counts({kind[0]} if term != kind[0] else set())
            phrases.append((np.concatenate([i, j]), np.concatenate([np.log1p(n.astype(float)), -np.log1p(m.astype(float))])))
    f_row, f_col, f_val = _sparse(phrases, place)
    fair.append((f_row + n_fair, f_col, f_val))
    n_fair += len(phrases)
    w, bias = _fit(x, y, tuple(np.concatenate(c) for c in zip(*fair, strict=True)), n_fair, len(chosen))
    return Model({int(i): float(v) for i, v in zip(chosen, w, strict=True)}, bias)


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text (0 to 1). Null and empty texts get the intercept's."""
    weights, bias = model.weights, model.bias
    small_batches(docs.sparkSession)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        one = _scorer(weights, bias)
        out = [one(t) for lo in range(0, len(texts), 256) for t in texts.slice(lo, 256).to_pylist()]
        return pa.array(out, type=pa.float64())

    return docs.withColumn(name, score(F.col(text)))


def _scorer(weights: dict[int, float], bias: float):
    """One scorer for each worker and model, so that its table of words outlives a task."""
    held, key = worker_cache("toxicity"), (len(weights), bias, sum(weights.values()))
    if held.get("scorer", (None,))[0] != key:
        held["scorer"] = key, Model(weights, bias).scorer()
    return held["scorer"][1]


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score and predicted (1 from ``CUT`` on).

    Every row is scored by its own whole text, also where rows share an id or are repeated; null and empty
    texts get the intercept's score; a null doc_id stays null and isn't held out. An empty table gives no
    rows; other columns are ignored, and so are the labels' columns other than doc_id and toxic."""
    out = scored(docs.select("doc_id", "text"), fit(docs, labels, max_rows), "text", "__score")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= CUT).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; all columns stay, whatever their names.

    As ``classify``: null and empty texts stay unless the intercept alone is rejected, repeated rows stay or
    go together, an empty table stays empty."""
    (score,) = free(docs, "__score")
    return scored(docs, fit(docs, labels, max_rows), "text", score).where(F.col(score) < CUT).select(*[F.col(f"`{c}`") for c in docs.columns])
