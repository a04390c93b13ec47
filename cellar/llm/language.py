"""Language identification by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior: the text (hashed letter trigrams
under one multinomial a language), the declared markup language (through a
confusion table), and the priors of address suffix and host.  Priors are smoothed
hierarchically, all addresses -> suffix -> host, and come from grouped
aggregations over every row: a host that holds a third of all rows sends one row
a task and language.

The text model is counted over all rows with a declared language, and every
declared language enters it, however few rows declare it: the counts of rare
languages shrink towards chance, and a trigram seen once says nothing.  A pass
holds ``BUCKETS`` numbers for each of ``GROUP_LANGUAGES`` languages; more languages
take more passes, whose posteriors add up.

Defined cases: null or empty texts and texts without letters give no text
evidence; they are not kept and carry the language that the other evidence
favours.  Null declared languages, suffixes and hosts give no evidence of that
kind.  Ties go to the smaller language code.  Repeated rows count each; a null id
is passed on; an empty table gives no rows; without any declared language the
language is null and nothing is kept.  Further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm import common as c
from cellar.llm.registry import query

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
CHUNK = 1 << 10
#: Languages of one pass.
GROUP_LANGUAGES = 256
#: Neighbouring trigrams overlap: so many count as one observation.
OVERLAP = 4.0
#: Weight, in rows, of the level above in a smoothed prior.
PRIOR_ROWS = 20.0
MIN_POSTERIOR = 0.5

_SYMBOL = np.zeros(256, np.uint32)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:] = 27 + np.arange(128)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of each letter trigram; marks and white space are one
    kind of gap, and a trigram has at least two letters."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s = _SYMBOL[data]
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    letters = (s > 0).view(np.int8)
    good = (doc[2:] == doc[:-2]) & (letters[:-2] + letters[1:-1] + letters[2:] >= 2)
    code = s[:-2] * np.uint32(0x9E3779B1) + s[1:-1] * np.uint32(0x85EBCA77) + s[2:] * np.uint32(0xC2B2AE3D)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    return (code >> np.uint32(32 - BUCKET_BITS))[good], doc[:-2][good]


COUNT_SCHEMA = pa.schema([("language", pa.string()), ("chunk", pa.int32()), ("counts", pa.binary())])


def _count(names):
    place = {n: i for i, n in enumerate(names)}

    def run(batches):
        held = {n: np.zeros(BUCKETS, np.int64) for n in names}
        for batch in c.chunks(batches):
            data, offsets = c.text_bytes(batch.column("text"))
            bucket, doc = trigrams(data, offsets)
            declared = batch.column("declared").to_pylist()
            number = np.array([place.get(x, -1) for x in declared])
            of = number[doc]
            for k, n in enumerate(names):
                if (number == k).any():
                    held[n] += np.bincount(bucket[of == k], minlength=BUCKETS)
        for n, counts in held.items():
            if counts.any():
                parts = counts.reshape(-1, CHUNK)
                yield pa.RecordBatch.from_pydict({
                    "language": [n] * len(parts), "chunk": list(range(len(parts))),
                    "counts": [p.tobytes() for p in parts]}, schema=COUNT_SCHEMA)
    return run


def _add_up(batches):
    key, total = None, None
    out = lambda: pa.RecordBatch.from_pydict(
        {"language": [key[0]], "chunk": [key[1]], "counts": [total.tobytes()]}, schema=COUNT_SCHEMA)
    for batch in batches:
        for language, chunk, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (language, chunk) != key:
                if key is not None:
                    yield out()
                key, total = (language, chunk), np.zeros(CHUNK, np.int64)
            total += np.frombuffer(counts, np.int64)
    if key is not None:
        yield out()


def languages(rows: DataFrame) -> dict[str, int]:
    """Every declared language and how many rows declare it, by language code."""
    found = rows.where(F.col("declared").isNotNull()).groupBy("declared").agg(F.count(F.lit(1)).alias("n")).collect()
    return dict(sorted((r.declared, r.n) for r in found))


def fit(rows: DataFrame, declared: dict[str, int]) -> np.ndarray:
    """Log probability, relative to chance, of each bucket and language."""
    names = list(declared)
    place = {n: i for i, n in enumerate(names)}
    ddl = "language string, chunk int, counts binary"
    sums = (rows.where(F.col("declared").isin(names)).select("declared", "text").mapInArrow(_count(names), ddl)
            .repartition("language", "chunk").sortWithinPartitions("language", "chunk").mapInArrow(_add_up, ddl).collect())
    counts = np.zeros((BUCKETS, len(names)))
    for r in sums:  # at most GROUP_LANGUAGES * BUCKETS numbers
        counts[r.chunk * CHUNK:(r.chunk + 1) * CHUNK, place[r.language]] = np.frombuffer(r.counts, np.int64)
    n = np.array(list(declared.values()), float)
    counts = np.maximum(counts - 1, 0) * (n / (n + PRIOR_ROWS))
    return np.log((counts + 0.5) * BUCKETS / (counts.sum(0) + 0.5 * BUCKETS))


def _groups(declared: dict[str, int]) -> list[dict[str, int]]:
    names = list(declared)
    return [{n: declared[n] for n in names[i:i + GROUP_LANGUAGES]} for i in range(0, len(names), GROUP_LANGUAGES)]


def train(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each bucket and language)."""
    declared = languages(rows)
    if not declared:
        return [], np.zeros((BUCKETS, 0))
    return list(declared), np.hstack([fit(rows, g) for g in _groups(declared)]) - np.log(BUCKETS)


def _score(model):
    def run(batches):
        table = model.value
        for batch in c.chunks(batches):
            data, offsets = c.text_bytes(batch.column("text"))
            bucket, doc = trigrams(data, offsets)
            n = np.bincount(doc, minlength=batch.num_rows)
            total = np.zeros((batch.num_rows, table.shape[1]))
            if len(bucket):
                has = np.flatnonzero(n)
                first = np.concatenate([[0], np.cumsum(n[has])[:-1]])
                for k in range(table.shape[1]):
                    total[has, k] = np.add.reduceat(table[:, k][bucket], first, dtype=np.float64)
            names = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in names), pa.array(n.astype(np.int64)), pa.array(list(total), pa.list_(pa.float64()))],
                names=[*names, "n_trigrams", "likelihood"])
    return run


def _scores(rows: DataFrame, groups: list[dict[str, int]]) -> list[DataFrame]:
    """For each group of languages: the rows with ``likelihood`` in that group and,
    over all groups, the text's ``best`` language (number from 0) and its ``gain``."""
    context = rows.sparkSession.sparkContext
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.select("id", "declared", "suffix", "host", "text")
    several = len(groups) > 1
    if several:
        rows = c.written(rows.withColumn("_row", F.monotonically_increasing_id()), "language-rows")
    ddl = f"id {kind}, declared string, suffix string, host string, {'_row long, ' * several}n_trigrams long, likelihood array<double>"
    columns = ["id", "declared", "suffix", "host", "text", *["_row"] * several]
    out, first = [], 0
    for group in groups:
        model = context.broadcast(fit(rows, group).astype(np.float32))
        scored = rows.select(*columns).mapInArrow(_score(model), ddl)
        most = F.array_max("likelihood")
        place = F.array_position("likelihood", most).cast("int") - 1 + first
        # nats a trigram above chance: a text in none of the languages has none
        scored = scored.withColumns({"best": F.when(F.col("n_trigrams") > 0, place),
                                     "gain": F.try_divide(most, F.col("n_trigrams"))})
        out.append(c.written(scored, "language-scores"))
        model.destroy()
        first += len(group)
    if several:
        top = None
        for scored in out:
            part = scored.select("_row", F.struct((-F.col("gain")).alias("loss"), "best").alias("top"))
            top = part if top is None else top.unionAll(part)
        top = c.written(top.groupBy("_row").agg(F.min("top").alias("top")), "language-best")
        out = [c.written(scored.drop("best", "gain").join(top, "_row").withColumns(
            {"best": F.col("top.best"), "gain": -F.col("top.loss")}).drop("top"), "language-scores") for scored in out]
    return out


def identify(rows: DataFrame) -> DataFrame:
    """``rows`` (id, text, declared, suffix, host) -> id, language, posterior,
    text_language, declared, n_trigrams, kept."""
    spark = rows.sparkSession
    declared = languages(rows)
    names = list(declared)
    if not names:
        return rows.select("id", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("posterior"),
                           F.lit(None).cast("string").alias("text_language"), "declared",
                           F.lit(0).cast("long").alias("n_trigrams"), F.lit(False).alias("kept"))
    k = len(names)
    groups = _groups(declared)
    scores = _scores(rows, groups)
    sure = scores[0].where(F.col("n_trigrams") >= 20)
    labels = spark.createDataFrame(list(enumerate(names)), "best int, text_language string")

    size = dict.fromkeys(range(k), 0)
    size.update((r.best, r.n) for r in sure.groupBy("best").agg(F.count(F.lit(1)).alias("n")).collect())
    # the declared ones of them
    named = dict.fromkeys(range(k), 0)
    named.update((r.best, r.n) for r in sure.where(F.col("declared").isNotNull()).groupBy("best")
                 .agg(F.count(F.lit(1)).alias("n")).collect())
    n_sure = sum(size.values())

    def smooth(n, above):
        return F.zip_with(n, above, lambda x, p: (x + PRIOR_ROWS * p) / (F.col("size") + PRIOR_ROWS))

    out, first = [], 0
    for group, scored in zip(groups, scores):
        here = range(first, first + len(group))
        first += len(group)
        counts = F.array(*[F.count(F.when(F.col("best") == i, 1)) for i in here])
        grouped = lambda key, *more: sure.where(F.col(key).isNotNull()).groupBy(key).agg(
            counts.alias("n"), F.count(F.lit(1)).alias("size"), *more)

        # declared language: how often it is said of texts of each language
        whole = F.array(*[F.lit(named[i] + 0.5 * k) for i in here])
        says = c.written(grouped("declared").select("declared", F.zip_with(
            "n", whole, lambda x, a: F.log((x + 0.5) / a)).alias("says")), "declared-languages")
        unsaid = F.transform(whole, lambda a: F.log(0.5 / a))
        none = F.transform(whole, lambda a: F.lit(0.0))

        # smoothed priors: everything -> suffix -> host
        everywhere = F.array(*[F.lit((size[i] + 1.0) / (n_sure + k)) for i in here])
        suffixes = grouped("suffix").select("suffix", smooth(F.col("n"), everywhere).alias("suffix_prior"))
        hosts = grouped("host", F.max("suffix").alias("suffix")).join(suffixes, "suffix", "left").select(
            "host", smooth(F.col("n"), F.coalesce("suffix_prior", everywhere)).alias("host_prior"))
        hosts = c.written(hosts, "host-priors")
        suffixes = c.written(suffixes, "suffix-priors")
        joined = scored.join(hosts, "host", "left").join(suffixes, "suffix", "left").join(F.broadcast(says), "declared", "left")
        prior = F.coalesce("host_prior", "suffix_prior", everywhere)
        total = F.zip_with(
            F.zip_with("likelihood", F.transform(prior, lambda x: F.log(x)), lambda a, b: a / OVERLAP + b),
            F.coalesce("says", F.when(F.col("declared").isNotNull(), unsaid).otherwise(none)), lambda a, b: a + b)
        top = F.array_max("total")
        part = joined.withColumn("total", total).withColumns({
            "language": F.get(F.array(*map(F.lit, group)), F.array_position("total", top).cast("int") - 1),
            "top": top, "mass": F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - top))})
        out.append(part.drop("likelihood", "total", "host_prior", "suffix_prior", "says"))
    if len(out) == 1:
        found = out[0]
    else:
        shares = None
        for part in out:
            part = part.select("_row", F.struct((-F.col("top")).alias("loss"), "language", "mass").alias("share"))
            shares = part if shares is None else shares.unionAll(part)
        found = shares.groupBy("_row").agg(F.min("share").alias("lead"), F.collect_list("share").alias("shares"))
        found = scores[0].select("_row", "id", "declared", "n_trigrams", "best", "gain").join(found, "_row").withColumns({
            "language": F.col("lead.language"),
            "mass": F.aggregate("shares", F.lit(0.0), lambda a, x: a + x["mass"] * F.exp(F.col("lead.loss") - x["loss"]))})
    # the posterior of the best is 1 / sum(exp(total - max))
    found = found.withColumn("posterior", 1.0 / F.col("mass")).join(F.broadcast(labels), "best", "left")
    kept = (F.col("n_trigrams") > 0) & (F.col("posterior") >= MIN_POSTERIOR) & (F.col("gain") > 0)
    return found.select("id", "language", "posterior", "text_language", "declared",
                        "n_trigrams", F.coalesce(kept, F.lit(False)).alias("kept"))


def document_rows(docs: DataFrame) -> DataFrame:
    """Evidence of the ``documents`` table: the source stands for the host."""
    rows = c.keyed(docs, "doc_id", "text", "lang", "source")
    return rows.select(F.col("doc_id").alias("id"), "text", F.col("lang").cast("string").alias("declared"),
                       F.lit(None).cast("string").alias("suffix"), F.col("source").cast("string").alias("host"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` whose language is identified, with that language in ``lang``; the
    rejected ones go.  Rows that differ in text, declared language or source have
    verdicts of their own; equal rows share one, and stay as many as they are."""
    key = F.xxhash64(*[y for x in ("doc_id", "text", "lang", "source") if x in docs.columns for y in (F.col(x).isNull(), F.col(x))])
    name, verdict = c.unused(docs, "row_key"), c.unused(docs, "identified")
    rows = document_rows(docs.withColumn("doc_id", key))
    found = identify(rows).where("kept").groupBy(F.col("id").alias(name)).agg(F.min("language").alias(verdict))
    out = docs.join(found, key == F.col(name))
    return out.withColumn("lang", F.col(verdict)).select(*docs.columns)


def page_rows(pages: DataFrame) -> DataFrame:
    """Evidence of raw web pages: text outside tags, the html element's lang
    attribute, the address's host and its last label."""
    html = F.coalesce(F.col("html"), F.lit(""))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "), r"<[^>]*>", " ")
    host = F.nullif(F.lower(F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))
    declared = F.nullif(F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)), F.lit(""))
    return pages.select(F.col("page_id").alias("id"), text.alias("text"), declared.alias("declared"),
                        F.substring_index(host, ".", -1).alias("suffix"), host.alias("host"))


@query("op4_language_id")
def op4(spark, sf_dir):
    return identify(document_rows(c.documents(spark, sf_dir))).withColumnRenamed("id", "doc_id")


@query("language_of_pages")
def language_of_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return identify(page_rows(pages)).withColumnRenamed("id", "page_id")
