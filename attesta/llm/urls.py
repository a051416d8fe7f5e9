"""URL filter: rules first, and a character language-model ratio for what no rule settles.

The URLs that rules accept and those that they reject train one character model each: variable-order
Markov models, interpolated by Witten-Bell,

    P(c | h) = (N(hc) + U(h) P(c | h')) / (N(h) + U(h)),

with N how often, U how many different characters follow the context h, h' the context without its first
character, and 1 / (characters in the corpus) below order 0; a context never seen leaves P(c | h').

All counts come from one table of the corpus's different windows of order + 1 characters: a character's
probability depends on nothing else, lower orders are sums over windows of equal ends, and a window's log
ratio is computed once however often it occurs. URLs are judged once for each different one, by the sum of
their windows' log ratios over their length. Log ratios are fixed-point (2**-20), so sums don't depend on their order.

Calibration: every labelled URL is scored by models that leave out its half of the labelled ones (halves by
MD5), and the cut is the middle of the gap below the least mean log ratio, in steps of 2**-10, that gives the
best balanced accuracy. Without both labels the cut is 0.

Nulls and URLs without ``://`` have empty host and path; the models read a null as an empty URL, which is its end
mark only. Repeated rows, null and repeated ids are rows like others, repeated URLs train as often as they occur,
long URLs are read whole, columns of other names ride along (a clashing one gives way), an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm.runtime import written

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Characters of the longest context, fractions of a nat of log ratios, and of those the steps of the cut.
ORDER, UNIT, STEP = 5, 1 << 20, 1 << 10
_BEGIN, _END = "\x02", "\x03"
_MODELS = ("all", "first", "second")


def host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """After the host, to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host: Column, path: Column, rules=RULES) -> Column:
    """A struct (rule, verdict) of the longest rule that fits, or null: the host is the rule's or below it, and the path
    begins with the rule's. Equal lengths go by the longer host, then the verdict. For short lists of rules."""
    out = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0]))]
    return F.coalesce(*out) if out else F.lit(None).cast("struct<rule:string,verdict:string>")


def _windows(urls: DataFrame, order: int, *kept: str) -> DataFrame:
    """A row for each character of each URL and its end: the character after the ``order`` before it."""
    padded = F.concat(F.lit(_BEGIN * order), "url", F.lit(_END))
    return urls.select(*kept, F.explode(F.transform(F.sequence(F.lit(1), F.length("url") + 1), lambda i: F.substring(padded, i, order + 1))).alias("w"))


def _ratios(counts: DataFrame, order: int) -> DataFrame:
    """(w, all, first, second): the log ratios of the windows of ``counts`` (w, a1, a2, r1, r2: how often they stand in the
    halves of the accepted and of the rejected) by the models of all, and of the first and the second half alone."""
    letters = max(1, counts.select(F.right("w", F.lit(1))).distinct().count())
    of = {"all": lambda x: F.col(f"{x}1") + F.col(f"{x}2"), "first": lambda x: F.col(f"{x}1"), "second": lambda x: F.col(f"{x}2")}
    names = [f"{x}_{m}" for x in "ar" for m in _MODELS]
    below = None
    for k in range(order + 1):
        level = counts.groupBy(F.right("w", F.lit(k + 1)).alias("g")).agg(*[F.sum(c).alias(c) for c in ("a1", "a2", "r1", "r2")])
        level = level.select("g", F.substring("g", 1, k).alias("h"), *[of[m](x).alias(f"n_{x}_{m}") for x in "ar" for m in _MODELS])
        contexts = level.groupBy("h").agg(*[e for c in names for e in (F.sum(f"n_{c}").alias(f"at_{c}"), F.count_if(F.col(f"n_{c}") > 0).alias(f"next_{c}"))])
        level = level.join(contexts, "h")
        if below is None:
            lower = level.withColumns({f"p_{c}": F.lit(1.0 / letters) for c in names})
        else:
            lower = level.withColumn("b", F.right("g", F.lit(k))).join(below.withColumnRenamed("g", "b"), "b")
        p = {f"p_{c}": F.when(F.col(f"at_{c}") > 0, (F.col(f"n_{c}") + F.col(f"next_{c}") * F.col(f"p_{c}")) / (F.col(f"at_{c}") + F.col(f"next_{c}"))).otherwise(F.col(f"p_{c}")) for c in names}
        below = lower.select("g", *[v.alias(c) for c, v in p.items()])
    return below.select(F.col("g").alias("w"), *[F.round((F.ln(f"p_a_{m}") - F.ln(f"p_r_{m}")) * UNIT).cast("long").alias(m) for m in _MODELS])


def _cut(scored: DataFrame) -> int:
    """The cut by the labelled URLs (step, accepted, rejected: rows). Steps are few, as log ratios have a range."""
    bins = scored.groupBy("step").agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).orderBy("step").collect()
    a, r = (sum(b[c] for b in bins) for c in "ar")
    if not a or not r:
        return 0
    best, cut, kept, gone, before = -1, 0, a, 0, None
    for b in bins:
        if (hits := kept * r + gone * a) > best:
            best, cut = hits, b["step"] if before is None else (b["step"] + before + 1) // 2
        kept, gone, before = kept - b["a"], gone + b["r"], b["step"]
    return cut


def judge(pages: DataFrame, url: str = "url", rules=RULES, order: int = ORDER) -> DataFrame:
    """The rows of ``pages`` with host, path, rule (null where none fits), verdict, score (the mean log ratio of
    accepted to rejected for each character, in nats; of labelled URLs by the models of the other half) and cut (the
    score from which URLs pass that no rule fits)."""
    named = {"host", "path", "rule", "verdict", "score", "cut", "__url"}
    rest = pages.drop(*[c for c in pages.columns if c.lower() in named and c != url]).withColumn("__url", F.coalesce(F.col(url), F.lit("")))
    found = pages.groupBy(F.coalesce(F.col(url), F.lit("")).alias("url")).agg(F.count("*").alias("rows")).withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    found = found.withColumn("rule", rule(F.col("host"), F.col("path"), rules)).withColumn("half", F.when(F.substring(F.md5("url"), 1, 1) < "8", 1).otherwise(2))
    # ids are made once, in a table, and stand for the URLs in what is shuffled
    urls = written(found.select(F.monotonically_increasing_id().alias("id"), "url", "host", "path", F.col("rule.rule").alias("rule"), F.col("rule.verdict").alias("verdict"), "half", "rows"))
    n = lambda verdict, half: F.sum(F.when((F.col("verdict") == verdict) & (F.col("half") == half), F.col("rows")).otherwise(0))
    counts = written(_windows(urls, order, "verdict", "half", "rows").groupBy("w").agg(n("allow", 1).alias("a1"), n("allow", 2).alias("a2"), n("block", 1).alias("r1"), n("block", 2).alias("r2")))
    ratios = _ratios(counts, order)
    # by the models of the other half where labelled
    own = F.when(F.col("verdict").isNull(), F.col("all")).when(F.col("half") == 1, F.col("second")).otherwise(F.col("first"))
    sums = _windows(urls, order, "id", "verdict", "half").join(ratios, "w").groupBy("id").agg(F.sum(own).alias("sum"), F.count("*").alias("n"))
    scored = written(urls.join(sums, "id").withColumn("step", F.floor(F.col("sum") / (F.col("n") * STEP)).cast("long")).drop("id"))
    cut = _cut(scored.where("verdict is not null").select("step", *[F.when(F.col("verdict") == v, F.col("rows")).otherwise(0).alias(c) for c, v in (("accepted", "allow"), ("rejected", "block"))]))
    of = scored.select(
        F.col("url").alias("__url"), "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("step") >= cut, "allow").otherwise("block")).alias("verdict"),
        (F.col("sum") / F.col("n") / UNIT).alias("score"), F.lit(cut * STEP / UNIT).alias("cut"),
    )
    return rest.join(of, "__url").drop("__url")
