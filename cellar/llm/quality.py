"""Quality rules: robust multivariate outliers per language and source.

Each document's text gives a vector of statistics (word length, symbols, capital
letters, digits, other punctuation, repeated words, repeated lines).  For each
(lang, source) group the minimum-covariance-determinant estimate is found by
concentration steps from three starts (the group's usual rates with the smallest
deviations, the same with the group's mean deviations, and the mean and covariance
of all its rows): from the current centre and covariance every document gets
its Mahalanobis distance, the nearest 75 % form the next subset, and the
subset's sums give the next centre and covariance.  The start that ends with the
smallest determinant is kept.  The subset's covariance is scaled up to that of all
rows, as it is for normal ones.  Sums are whole numbers (statistics are rounded to
1/1024), so the result does not depend on the order of rows.  Documents far outside
the final estimate are rejected.

Every step is one grouped aggregation with map-side sums: a group that holds a
third of all rows sends one row a task.  The cut of a step is found on a
histogram of distances with a fixed number of bins, never by sorting a group.

Defined cases: null or empty texts have zero words and fail the base rules; null
lang or source are groups of their own; a group of fewer than ``min_group``
documents that pass the base rules is judged by the estimate over all documents of
its language, and where these are too few by the one over the whole table, so that
every document is judged; equal documents get equal verdicts (ties between starts go
to the first); repeated rows give one row each; a null doc_id is passed on; other
columns are not read; a very long text is measured whole; an empty table has no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm import common as c
from cellar.llm.registry import query

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
UPPER = np.isin(np.arange(256), np.arange(65, 91))
DIGIT = np.isin(np.arange(256), np.arange(48, 58))
PUNCT = np.isin(np.arange(256), np.frombuffer(b"!\"'()+,-./:;=?@[\\]^_`{}~", np.uint8))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_upper", "n_digits", "n_punct", "n_lines"]
SCHEMA = "doc_id long, lang string, source string, " + ", ".join(f"{x} long" for x in COUNTS)
WINDOW = 5


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each document, as arrays."""
    n = len(offsets) - 1
    starts, ends, docs = c.words_of(data, offsets)
    where = np.repeat(np.arange(n), np.diff(offsets))
    count = lambda mask: np.bincount(where[mask], minlength=n)
    out = {"n_words": np.bincount(docs, minlength=n),
           "word_chars": count(~c.SPACE[data] & ((data & 0xC0) != 0x80)),
           "n_symbols": count(SYMBOLS[data]), "n_upper": count(UPPER[data]),
           "n_digits": count(DIGIT[data]), "n_punct": count(PUNCT[data])}
    # lines with a word that equal an earlier line of the document
    ls, le, ld = c.lines_of(data, offsets)
    has = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    h = c.span_hash(data, ls[has], le[has], c.EXACT_CODE)
    d = ld[has]
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
    out["n_dup_lines"] = np.bincount(d[same], minlength=n)
    out["n_lines"] = np.bincount(ld, minlength=n)
    # words inside 5-word windows that occur twice or more
    covered = np.zeros(len(docs) + 1, np.int64)
    m = len(docs) - WINDOW + 1
    if m > 0:
        words = c.span_hash(data, starts, ends, c.EXACT_CODE)
        odd = c.powers(WINDOW + 1, 0xD1342543DE82EF95)[1:]
        total = np.zeros(m, np.uint64)
        for j in range(WINDOW):
            total += words[j:m + j] * odd[j]
        at = np.flatnonzero(docs[:m] == docs[WINDOW - 1:])
        h, d = c.mix(total[at]), docs[at]
        order = np.lexsort((h, d))
        h, d, at = h[order], d[order], at[order]
        same = np.zeros(len(h) + 1, bool)
        same[1:-1] = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
        at = at[same[:-1] | same[1:]]
        np.add.at(covered, at, 1)
        np.subtract.at(covered, at + WINDOW, 1)
    out["n_repeat_words"] = np.bincount(docs[np.cumsum(covered)[:-1] > 0], minlength=n)
    return out


def _measure(batches):
    for batch in c.chunks(batches):
        got = statistics(*c.text_bytes(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [batch.column(x) for x in ("doc_id", "lang", "source")] + [pa.array(got[x].astype(np.int64)) for x in COUNTS],
            names=["doc_id", "lang", "source", *COUNTS])


def measure(docs: DataFrame) -> DataFrame:
    return c.keyed(docs, "doc_id", "text", "lang", "source").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")
    ).mapInArrow(_measure, SCHEMA)


# ---------------------------------------------------------------------------
# minimum-covariance-determinant estimate per group

#: Statistic -> (count, per count, smallest standard deviation of its transform).
RATES = {
    "word_length": ("word_chars", "n_words", 0.05),
    "symbols": ("n_symbols", "n_words", 0.10),
    "capitals": ("n_upper", "n_words", 0.05),
    "digits": ("n_digits", "n_words", 0.25),
    "punctuation": ("n_punct", "n_words", 0.05),
    "repeats": ("n_repeat_words", "n_words", 0.10),
    "equal_lines": ("n_dup_lines", "n_lines", 0.10),
}
UNIT = 1024
#: A rate counts as if this many more words (lines) had the group's usual rate,
#: so that short documents do not stand out by chance.
PRIOR = 30
P = len(RATES)
FLOORS = np.array([x[2] * UNIT for x in RATES.values()])
#: 99.99 % point of chi-square with 7 degrees of freedom.
CUTOFF = 29.88
SUBSET = 0.75
#: The covariance of the nearest 75 % of normal rows in 7 dimensions is this much smaller
#: than that of all: 0.75 / P(chi-square(9) <= the 75 % point of chi-square(7)).
CONSISTENCY = 1.3247
STEPS = 5
#: Distances are binned by 1/16 of a doubling.
BINS = 16
STATE = "grp string, start int, centre array<double>, inverse array<double>, log_det double"
EVERYTHING = "*"


def _group():
    mark = lambda x: F.coalesce(F.concat(F.lit("="), F.col(x)), F.lit("-"))
    return F.concat(mark("lang"), F.lit("\n"), mark("source")), F.concat(mark("lang"), F.lit("\n*"))


def _distance(v="v"):
    """Squared Mahalanobis distance of the row's vector under its group's state."""
    diff = [F.col(v)[i] - F.col("centre")[i] for i in range(P)]
    total = None
    for i in range(P):
        for j in range(i, P):
            term = diff[i] * diff[j] * F.col("inverse")[i * P + j] * (1 if i == j else 2)
            total = term if total is None else total + term
    return total


def _estimate(factor):
    """Group sums -> centre, inverse and determinant of the covariance times ``factor``."""
    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                n = r["n"]
                centre = np.array([float(x) for x in r["s"]]) / n
                cov = np.zeros((P, P))
                k = 0
                for i in range(P):
                    for j in range(i, P):
                        cov[i, j] = cov[j, i] = r["q"][k] / n - centre[i] * centre[j]
                        k += 1
                cov = cov * factor + np.diag(FLOORS ** 2)
                out.append((r["grp"], r["start"], centre.tolist(), np.linalg.inv(cov).ravel().tolist(),
                            float(np.linalg.slogdet(cov)[1])))
            cols = list(zip(*out)) if out else [()] * 5
            kinds = [pa.string(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds)],
                                             names=["grp", "start", "centre", "inverse", "log_det"])
    return run


def _sums(rows: DataFrame, *more) -> DataFrame:
    v = [F.col("v")[i] for i in range(P)]
    pairs = [(i, j) for i in range(P) for j in range(i, P)]
    sums = rows.groupBy("grp", "start").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(v[i]).alias(f"s{i}") for i in range(P)],
        *[F.sum(v[i] * v[j]).alias(f"q{i}_{j}") for i, j in pairs], *more)
    return sums.withColumn("s", F.array(*[f"s{i}" for i in range(P)])).withColumn("q", F.array(*[f"q{i}_{j}" for i, j in pairs]))


def _starts(inside: DataFrame, usual: DataFrame) -> DataFrame:
    """(grp, start, centre, inverse): the three starts of each group."""
    centre = usual.select("grp", F.transform("usual", lambda r: F.sqrt(r) * UNIT).alias("centre"))
    away = [F.sum(F.abs(F.col("v")[i] - F.round(F.col("centre")[i]).cast("long"))).alias(f"d{i}") for i in range(P)]
    sums = c.written(_sums(inside.join(centre, "grp").withColumn("start", F.lit(2)), F.first("centre").alias("centre"), *away)
                     .select("grp", "start", "n", "s", "q", "centre", *[f"d{i}" for i in range(P)]), "sums")

    def diagonal(deviation):
        return F.array(*[1 / F.pow(deviation(i), 2) if i == j else F.lit(0.0) for i in range(P) for j in range(P)])

    # 1.2533 mean deviations are a standard deviation
    narrow = diagonal(lambda i: F.lit(float(FLOORS[i])))
    wide = diagonal(lambda i: F.greatest(F.lit(float(FLOORS[i])), 1.2533 * F.col(f"d{i}") / F.col("n")))
    made = [sums.select("grp", F.lit(k).alias("start"), "centre", x.alias("inverse")) for k, x in enumerate((narrow, wide))]
    whole = sums.select("grp", "start", "n", "s", "q").mapInArrow(_estimate(1.0), STATE)
    return made[0].unionAll(made[1]).unionAll(whole.select("grp", "start", "centre", "inverse"))


def _up_to(hist: DataFrame, keys: list[str], value: str, share: float, name: str) -> DataFrame:
    """The smallest value of each key up to which that share of the counts lies.
    A key has a bounded number of values."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys)
    cum = hist.withColumn("upto", F.sum("n").over(w.orderBy(value))).withColumn("all", F.sum("n").over(w))
    return cum.where(F.col("upto") >= F.lit(share) * F.col("all")).groupBy(*keys).agg(F.min(value).alias(name))


def judge(stats: DataFrame, min_group: int = 50, cutoff: float = CUTOFF, min_words: int = 10,
          max_repeat: int = 20) -> DataFrame:
    """``stats`` (of ``measure``) with base_failed, distance and kept."""
    group, pool = _group()
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    stats = stats.withColumn("base_failed", base).withColumn("own", group).withColumn("pool", pool)
    # the group that judges a document, and the estimates it goes into
    sizes = stats.where(~F.col("base_failed")).groupBy("own", "pool").agg(F.count(F.lit(1)).alias("n_own"))
    pools = sizes.groupBy("pool").agg(F.sum("n_own").alias("n_pool"), F.min("n_own").alias("least_own"))
    sizes = c.written(sizes.join(pools, "pool"), "sizes")
    few = not sizes.where((F.col("n_own") < min_group) & (F.col("n_pool") < min_group)).isEmpty()
    own, in_pool = F.col("n_own") >= min_group, F.col("n_pool") >= min_group
    sizes = sizes.select("own", F.when(own, F.col("own")).when(in_pool, F.col("pool")).otherwise(EVERYTHING).alias("judge"), F.array_compact(
        F.array(F.when(own, F.col("own")), F.when(in_pool & (F.col("least_own") < min_group), F.col("pool")),
                F.lit(EVERYTHING if few else None).cast("string"))).alias("members"))
    stats = stats.join(sizes, "own", "left").drop("own", "pool").withColumn(
        "judge", F.when(~F.col("base_failed"), F.col("judge")))
    stats = stats.withColumn("grp", F.explode_outer(F.when(~F.col("base_failed"), F.col("members")))).drop("members")
    # a rate beyond 16 is rounded to 14 digits of its binary number, so that a histogram has few values
    rate = [F.round(F.lit(UNIT) * F.col(x) / F.col(n)) for x, n, _ in RATES.values()]
    step = [F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(F.greatest(x, F.lit(1.0)))) - 13, F.lit(0))) for x in rate]
    ratio = [(F.floor(x / y) * y).cast("long") for x, y in zip(rate, step)]
    hist = (stats.where(F.col("grp").isNotNull()).select("grp", F.posexplode(F.array(*ratio)).alias("pos", "val"))
            .groupBy("grp", "pos", "val").agg(F.count(F.lit(1)).alias("n")))
    usual = c.written(_up_to(hist, ["grp", "pos"], "val", 0.5, "usual").groupBy("grp").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "usual"))), lambda x: x["usual"] / F.lit(float(UNIT)))
        .alias("usual")), "usual-rates")
    vector = F.array(*[F.round(F.lit(UNIT) * F.sqrt((F.col(x) + PRIOR * F.col("usual")[i]) / (F.col(n) + PRIOR))).cast("long")
                       for i, (x, n, _) in enumerate(RATES.values())])
    rows = c.written(stats.join(usual, "grp", "left").withColumn("v", F.when(F.col("grp").isNotNull(), vector))
                     .drop("usual"), "vectors")
    inside = rows.where(F.col("grp").isNotNull()).select("grp", "v")
    state = c.written(_starts(inside, usual), "state")
    for _ in range(STEPS):
        near = inside.join(state, "grp").select(
            "grp", "start", "v", F.floor(F.log2(_distance() + F.lit(1e-6)) * BINS).cast("int").alias("bin"))
        hist = near.groupBy("grp", "start", "bin").agg(F.count(F.lit(1)).alias("n"))
        cut = c.written(_up_to(hist, ["grp", "start"], "bin", SUBSET, "cut"), "cut")
        chosen = near.join(cut, ["grp", "start"]).where(F.col("bin") <= F.col("cut"))
        state = c.written(_sums(chosen).select("grp", "start", "n", "s", "q").mapInArrow(_estimate(CONSISTENCY), STATE), "state")
    best = state.groupBy("grp").agg(F.min_by(F.struct("centre", "inverse"), F.struct("log_det", "start")).alias("best")).select("grp", "best.*")
    out = rows.where(F.col("grp").eqNullSafe(F.col("judge"))).join(best, "grp", "left").withColumn("distance", _distance())
    return out.drop("judge").withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("distance") > cutoff, F.lit(False)))


def quality(docs: DataFrame, **options) -> DataFrame:
    """One row for each document: its counts, base_failed, distance and kept."""
    # read several times: the texts are measured once
    return judge(c.written(measure(docs), "statistics"), **options).drop("v", "centre", "inverse", "grp")


@query("op6_robust_outliers")
def op6(spark, sf_dir):
    return quality(c.documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "lang", "source", "distance")
