"""Benchmark decontamination by template windows.

Texts are canonicalised to templates: numbers, units behind numbers, and names
(a capitalised word inside a sentence) become typed placeholders; other words are
lower-cased, and punctuation and the kind of white space do not count.  Every
window of 8 template tokens is hashed, and the windows of documents and benchmark
items meet in a hash join.  A capitalised word at the start of a sentence is a
word in one reading and a name in the other; both are hashed.
Windows of one document and item that lie on one diagonal (document position less
item position) belong together.  Their slots are then compared: a slot value of
the item must always have met the same value in the document, and a name of the
document the same name of the item, as they do when a question was copied or asked
again with other numbers and names (two numbers may become one).  An item's
window counts once, on however many diagonals it is found.

The whole path is DataFrame functions.  Every fourth token of a document is a place.
Each window holds, whole, the 5 tokens behind the first place that it meets, so only
places whose 5 tokens stand in some item's window are looked at further: their
windows are made and joined.  No text leaves its row, and no other window is hashed.

Windows that say too little as templates match with all their values: an item of
fewer tokens than a window is one window of its own length (below 4 tokens: a whole
line of the document), and so is a window of an item with more than 4 slots.  The
documents' windows are hashed so only where the benchmark has such items.

Defined cases: null or empty texts, texts without letters and digits and empty tables
match nothing; items of equal text are matched each; repeated rows count once; a
document that holds several items has a row for each (there are no ties to break);
null ids are carried; further columns are not read, whatever their names; a long text
is one row, whose windows are made in blocks of 4096 places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellar.llm import common as c
from cellar.llm.registry import query

WINDOW = 8
MAX_SLOTS = 4
#: Windows that must match on one diagonal (all of them for an item with fewer).
MIN_WINDOWS = 3
#: Items of fewer tokens match as whole lines alone; a word or two say nothing inside one.
MIN_INSIDE = 4
#: Every fourth token is a place; the tokens about it hold the windows that start there or up to 3 tokens before.
STRIDE, AROUND = 4, 11
#: Places of a long text that are in memory at a time.
BLOCK = 4096
#: Benchmark windows up to this many are broadcast (about 100 bytes each).
BROADCAST_WINDOWS = 400_000
#: Keys of documents that go, up to which they are broadcast (16 bytes each).
BROADCAST_ROWS = 400_000
# Units of measure that may stand behind a number.
UNITS = ("percent|km/h|kmh|mph|km|cm|mm|metres|meters|metre|meter|m|miles|mile|feet|foot|ft|inches|inch|yards|kg|"
         "grams|gram|g|mg|pounds|lbs|lb|ounces|oz|tons|litres|liters|litre|liter|ml|l|hours|hour|hrs|h|minutes|"
         "minute|min|seconds|second|sec|s|days|day|weeks|week|months|month|years|year|degrees|degree|dollars|"
         "dollar|euros|euro|cents|cent|usd|eur|gbp|watts|watt|w|kw|kwh|volts|volt|v|hz|khz|mhz|ghz|kb|mb|gb|tb")
_NAME, _NUMBER, _UNIT, _START = "\u0002", "\u0003", "\u0004", "\u0005"


def _marked_tokens(text: Column) -> Column:
    """Lower-case tokens behind the mark of their type; a capitalised word at the
    start of a sentence has a mark of its own."""
    # each pattern begins with one class or mark, so that most characters are passed over at once
    text = F.regexp_replace(text, r"[\s\xA0](?:[\s\xA0]+|(?<! ))", " ")
    text = F.regexp_replace(text, r"\p{Lu}(?<![\p{L}\p{N}]\p{Lu})(?=\p{Ll})", f"{_START}$0")
    text = F.regexp_replace(text, rf"{_START}(?<=[\p{{L}}\p{{N}},;][ ]{_START})", _NAME)
    text = F.regexp_replace(text, r"\p{N}(?<![\p{L}\p{N}.,]\p{N})", f"{_NUMBER}$0")
    text = F.regexp_replace(F.lower(text), rf"{_NUMBER}([\p{{N}}.,]*\p{{N}})[ ]?(?:%|({UNITS})(?![\p{{L}}\p{{N}}]))",
                            rf"{_NUMBER}$1 {_UNIT}unit$2")
    text = F.regexp_replace(text, rf"[$€£](?={_NUMBER})", f"{_UNIT}money ")
    # a point or comma between digits belongs to their token
    run = rf"[a-z\p{{L}}\p{{N}}{_NAME}-{_START}]+"
    return F.regexp_extract_all(text, F.lit(rf"{run}(?:(?<=\p{{N}})[.,](?=\p{{N}}){run})*"), F.lit(0))


def _bare(x):
    return F.substring(x, 2, 1 << 30)


def _below(x: Column, code: int) -> Column:
    """Whether the first character of a token comes before ``code`` (or there is none):
    a comparison of bytes, which unlike ``ascii`` makes no new string for each token."""
    return x < F.lit(chr(code))


def _is_start(x: Column) -> Column:
    return ~_below(x, ord(_START)) & _below(x, ord(_START) + 1)


def template_tokens(text: Column) -> Column:
    """Lower-case tokens; a slot's token begins with the mark of its type."""
    return F.transform(_marked_tokens(text), lambda x: F.when(_is_start(x), _bare(x)).otherwise(x))


#: Readings of a window: sentence-initial capitalised words are words; they are
#: names; every token counts with its value.
#: With both: a place whose core is the same in the first two.
WORDS, NAMES, EXACT, BOTH = 0, 1, 2, 3


def _token_hash(reading):
    mark = lambda x: F.xxhash64(F.ascii(x))
    if reading == WORDS:
        return lambda x: F.when(_below(x, 6), F.when(_below(x, 5), mark(x)).otherwise(F.xxhash64(_bare(x)))).otherwise(F.xxhash64(x))
    if reading == NAMES:
        return lambda x: F.when(_below(x, 6), F.when(_below(x, 5), mark(x)).otherwise(
            F.xxhash64(F.lit(ord(_NAME))))).otherwise(F.xxhash64(x))
    return lambda x: F.when(_below(x, 6), F.xxhash64(_bare(x))).otherwise(F.xxhash64(x))


def _slots(tokens: Column, pos: Column, reading: Column) -> Column:
    """Values of the slots of a window: none in the exact reading."""
    inside = F.filter(F.slice(tokens, pos + 1, WINDOW), lambda x: F.ascii(x) < F.when(reading == NAMES, 6).otherwise(5))
    values = F.transform(inside, lambda x: F.when(F.ascii(x) == 5, F.concat(F.lit(_NAME), _bare(x))).otherwise(x))
    return F.when(reading != EXACT, values)


def _places(df: DataFrame, *ids: str) -> DataFrame:
    """(ids, place, around) for every fourth place of column ``tokens``: ``around``
    holds the 3 tokens before it (empty before the text), itself and the 7 behind."""
    width = STRIDE * BLOCK
    df = df.select(*ids, F.concat(F.array(*[F.lit("")] * (STRIDE - 1)), "tokens").alias("tokens"), F.size("tokens").alias("_n"))
    starts = F.sequence(F.lit(0), F.greatest(F.col("_n") - 1, F.lit(0)), F.lit(width))
    df = df.select(*ids, F.posexplode(F.transform(starts, lambda i: F.slice("tokens", i + 1, width + 7))).alias("_block", "tokens"))
    last = F.least(F.size("tokens") - STRIDE, F.lit(width - 1))
    df = df.where(last >= 0).select(*ids, "_block", F.posexplode(F.transform(
        F.sequence(F.lit(0), last, F.lit(STRIDE)), lambda i: F.slice("tokens", i + 1, AROUND))).alias("place", "around"))
    return df.select(*ids, (F.col("_block") * width + F.col("place") * STRIDE).alias("place"), "around")


def _hash(hashes: Column | list, start: int, n: int, seed: int) -> Column:
    at = (lambda i: hashes[i]) if isinstance(hashes, list) else (lambda i: F.get(hashes, F.lit(i)))
    return F.xxhash64(F.lit(seed), *[at(start + i) for i in range(n)])


def _screened(df: DataFrame, runs: DataFrame, exact: list[int]) -> DataFrame:
    """The places whose window cores are among ``runs``, once per reading (``both``
    where the two template readings have one core).  A window that starts at a
    place or up to 3 tokens before holds the core: all its length but 3 tokens."""
    token = [F.get("around", F.lit(i)) for i in range(AROUND)]

    def core(reading, n):
        one = _token_hash(reading)
        h = [F.lit(None) if i < STRIDE - 1 else one(x) for i, x in enumerate(token)]
        full = F.size("around") >= STRIDE - 1 + n - 3
        return F.when(full, _hash(h, STRIDE - 1, n - 3, n if reading == EXACT else 0))

    starts = F.lit(False)
    for x in token[STRIDE - 1:WINDOW]:
        starts = starts | _is_start(x)
    df = df.withColumn("_w", core(WORDS, WINDOW)).withColumn("_s", F.when(starts, core(NAMES, WINDOW)))
    probe = lambda h, reading, n: F.struct(h.alias("core"), F.lit(reading).alias("reading"), F.lit(n).alias("length"))
    probes = F.when(F.col("_s").isNull(), F.array(probe(F.col("_w"), BOTH, WINDOW))).otherwise(
        F.array(probe(F.col("_w"), WORDS, WINDOW), probe(F.col("_s"), NAMES, WINDOW)))
    if exact:
        probes = F.concat(probes, F.array(*[probe(core(EXACT, n), EXACT, n) for n in exact]))
    rest = [x for x in df.columns if x not in ("_w", "_s")]
    df = df.select(*rest, F.explode(probes).alias("_p")).select(*rest, "_p.*").where(F.col("core").isNotNull())
    return df.join(runs, "core", "left_semi").drop("core")


def _windows(df: DataFrame, exact: list[int], *ids: str) -> DataFrame:
    """(ids, pos, reading, length, h, around, first) of the windows that start at a
    place or up to 3 tokens before: in both template readings (in the second where
    it differs), and exact ones of each length in ``exact``.  Column ``reading``,
    where there is one, names those to make."""
    token = [F.get("around", F.lit(i)) for i in range(AROUND)]
    for reading in (WORDS, NAMES, *([EXACT] if exact else [])):
        df = df.withColumn(f"_t{reading}", F.array(*[_token_hash(reading)(x) for x in token]))
    screened = "reading" in df.columns
    blocks = [(WORDS, WINDOW), (NAMES, WINDOW), *((EXACT, n) for n in exact)]
    found = []
    for reading, n in blocks:
        asked = F.lit(True)
        if screened:
            asked = F.col("reading").isin(reading, BOTH) if reading != EXACT else (F.col("reading") == EXACT) & (F.col("length") == n)
        for k in range(STRIDE):
            inside = (F.size("around") >= k + n) & (F.col("place") + k >= STRIDE - 1)
            h = _hash(F.col(f"_t{reading}"), k, n, n if reading == EXACT else 0)
            if reading == NAMES:
                h = F.nullif(h, _hash(F.col(f"_t{WORDS}"), k, n, 0))
            found.append(F.struct((F.col("place") + (k - STRIDE + 1)).alias("pos"), F.lit(reading).alias("reading"),
                                  F.lit(n).alias("length"), F.when(asked & inside, h).alias("h"), F.lit(k).alias("first")))
    df = df.select(*ids, "around", F.explode(F.array(*found)).alias("_w")).select(*ids, "around", "_w.*")
    return df.where(F.col("h").isNotNull())


def _line_hash(tokens: Column) -> Column:
    return F.xxhash64(F.lit(-1), F.transform(tokens, _token_hash(EXACT)))


def _whole_lines(rows: DataFrame) -> DataFrame:
    """(row_key, doc_id, pos, h) of the lines of fewer than ``MIN_INSIDE`` tokens."""
    lines = rows.select("row_key", "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.select("row_key", "doc_id", "pos", _marked_tokens(F.col("line")).alias("tokens"))
    return lines.where(F.size("tokens").between(1, MIN_INSIDE - 1)).select("row_key", "doc_id", "pos", _line_hash(F.col("tokens")).alias("h"))


def _benchmark_windows(items: DataFrame) -> DataFrame:
    """(item_id, item_pos, item_reading, length, h, item_slots, cores): an item
    shorter than a window has one of its own length (length 0: a whole line), and a
    window with more than ``MAX_SLOTS`` slots is exact."""
    items = items.select("item_id", "text").distinct().withColumn("tokens", _marked_tokens(F.col("text")))
    items = items.withColumn("_item", F.xxhash64("item_id", "text")).withColumn("_size", F.size("tokens"))
    ids = ("item_id", "_item", "_size")
    exact = list(range(MIN_INSIDE, WINDOW + 1))
    found = _windows(_places(items, *ids), exact, *ids)
    found = found.withColumn("item_slots", _slots(F.col("around"), F.col("first"), F.col("reading")))
    place = Window.partitionBy("_item", "item_id", "pos")
    found = found.withColumn("_dense", F.max(F.when(F.size("item_slots") > MAX_SLOTS, 1).otherwise(0)).over(place))
    keep = F.when(F.col("reading") != EXACT, F.size("item_slots") <= MAX_SLOTS).otherwise(
        F.when(F.col("_size") < WINDOW, F.col("length") == F.col("_size")).otherwise(
            (F.col("length") == WINDOW) & (F.col("_dense") == 1)))
    # the cores of a window that the places of a document can meet
    token = F.when(F.col("reading") == WORDS, F.transform("around", _token_hash(WORDS))).when(
        F.col("reading") == NAMES, F.transform("around", _token_hash(NAMES))).otherwise(F.transform("around", _token_hash(EXACT)))
    found = found.where(keep).withColumn("_t", token)

    def core(i):
        start = F.col("first") + i
        of = lambda n, seed: F.xxhash64(F.lit(seed), *[F.get("_t", start + j) for j in range(n - 3)])
        h = of(WINDOW, 0)
        for n in exact:
            h = F.when((F.col("reading") == EXACT) & (F.col("length") == n), of(n, n)).otherwise(h)
        return h

    found = found.select("item_id", F.col("pos").alias("item_pos"), F.col("reading").alias("item_reading"),
                         "length", "h", "item_slots", F.array(*[core(i) for i in range(STRIDE)]).alias("cores"))
    whole = items.where(F.col("_size").between(1, MIN_INSIDE - 1)).select(
        "item_id", F.lit(0).alias("item_pos"), F.lit(EXACT).alias("item_reading"), F.lit(0).alias("length"),
        _line_hash(F.col("tokens")).alias("h"), F.lit(None).cast("array<string>").alias("item_slots"),
        F.lit(None).cast("array<bigint>").alias("cores"))
    return found.unionByName(whole)


def find_leaks(docs: DataFrame, items: DataFrame, min_windows: int = MIN_WINDOWS) -> DataFrame:
    """(row_key, doc_id, item_id, n_windows, item_windows, n_slots, n_changed):
    the pairs of a document and a benchmark item it contains, as a copy
    (``n_changed`` 0) or with other slot values.  ``n_windows`` are the item's windows
    that match with sentence-initial words as they are or, where these are too few, in
    any reading; slots are those of the diagonal with the most windows."""
    bench = c.written(_benchmark_windows(items), "benchmark-windows")
    template = F.col("item_reading") == WORDS
    held = bench.groupBy("item_id").agg(F.countDistinct("item_pos").alias("item_windows"),
                                        F.countDistinct(F.when(template, F.col("item_pos"))).alias("template_windows"))
    exact = [r.length for r in bench.where(F.col("item_reading") == EXACT).select("length").distinct().sort("length").collect()]
    small = bench.count() <= BROADCAST_WINDOWS
    known = F.broadcast if small else (lambda x: x)
    runs = known(bench.select(F.explode("cores").alias("core")).distinct())
    right = bench.drop("length", "cores")
    rows = docs.select("doc_id", "text").withColumn("row_key", F.xxhash64("doc_id", "text"))
    ids, lengths = ("row_key", "doc_id"), [n for n in exact if n]
    places = _places(rows.select(*ids, _marked_tokens(F.col("text")).alias("tokens")), *ids)
    inside = _windows(_screened(places, runs, lengths), lengths, *ids).drop("length").join(known(right), "h")
    inside = inside.withColumn("slots", _slots(F.col("around"), F.col("first"), F.col("reading"))).drop("around", "first")
    if 0 in exact:
        inside = inside.unionByName(_whole_lines(rows).withColumn("reading", F.lit(EXACT)).join(
            known(right.where(F.col("item_reading") == EXACT)), "h").withColumn("slots", F.lit(None).cast("array<string>")))
    met = c.written(inside.drop("h").distinct(), "met-windows")
    same = F.col("reading") == F.col("item_reading")
    plain = same & (F.col("reading") != NAMES)
    pairs = F.arrays_zip("item_slots", "slots")
    positions = lambda when: F.collect_set(F.when(when, F.col("item_pos")))
    line = met.groupBy(*ids, "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")).agg(
        positions(same & (F.col("reading") == WORDS)).alias("in_template"), positions(plain).alias("in_plain"),
        F.collect_set("item_pos").alias("in_any"),
        F.array_distinct(F.flatten(F.collect_set(F.when(plain, pairs)))).alias("plain_pairs"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("any_pairs"))

    def steady(x):
        """A value of the item always met the same value, and a name of the document the same name."""
        names = F.filter(x, lambda p: F.ascii(p["slots"]) == 2)
        once = lambda of, side: F.size(F.array_distinct(F.transform(of, lambda p: p[side]))) == F.size(of)
        return once(x, "item_slots") & once(names, "slots")

    # if not with names at sentence starts, then without them
    line = line.withColumn("_any", steady("any_pairs")).withColumn("_plain", steady("plain_pairs"))
    line = line.where(F.col("_any") | (F.col("_plain") & (F.size("in_plain") > 0)))
    line = line.withColumn("in_any", F.when(F.col("_any"), F.col("in_any")).otherwise(F.col("in_plain")))
    line = line.withColumn("any_pairs", F.when(F.col("_any"), F.col("any_pairs")).otherwise(F.col("plain_pairs")))
    for x in ("in_template", "in_plain", "plain_pairs"):
        line = line.withColumn(x, F.when(F.col("_plain"), F.col(x)).otherwise(F.slice(x, 1, 0)))
    said = lambda n, x: F.struct(F.size(n), F.size(x).cast("long").alias("slots"), F.size(
        F.filter(x, lambda p: p["item_slots"] != p["slots"])).cast("long").alias("changed"))
    line = line.withColumn("plain", said("in_plain", "plain_pairs")).withColumn("any", said("in_any", "any_pairs"))
    # a passage with a word put in or left out goes on on the next diagonal; a position counts once
    at = lambda x: F.array_contains(x, F.col("item_pos")).cast("int")
    each = line.select(*ids, "item_id", "plain", "any", "in_template", "in_plain",
                       F.explode(F.array_union("in_any", "in_plain")).alias("item_pos"), "in_any")
    each = each.groupBy(*ids, "item_id", "item_pos").agg(
        F.max(at("in_template")).alias("t"), F.max(at("in_plain")).alias("p"), F.max(at("in_any")).alias("a"),
        F.max("plain").alias("plain"), F.max("any").alias("any"))
    best = each.groupBy(*ids, "item_id").agg(
        *[F.sum(x).alias(n) for x, n in (("t", "n_template"), ("p", "n_plain"), ("a", "n_any"))],
        F.max("plain").alias("plain"), F.max("any").alias("any"))
    best = best.join(held, best["item_id"].eqNullSafe(held["item_id"])).drop(held["item_id"])
    enough = lambda n, of: (F.col(of) > 0) & (F.col(n) >= F.least(F.lit(min_windows), F.col(of)))
    alone = enough("n_template", "template_windows") | enough("n_plain", "item_windows")
    best = best.where(alone | enough("n_any", "item_windows"))
    pick = lambda a, b: F.when(alone, F.col(a)).otherwise(F.col(b))
    return best.select(
        *ids, "item_id", pick("n_plain", "n_any").alias("n_windows"), "item_windows",
        pick("plain.slots", "any.slots").alias("n_slots"), pick("plain.changed", "any.changed").alias("n_changed"))


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item."""
    key, doc = c.unused(docs, "row_key"), c.unused(docs, "bad_doc")
    bad = c.written(find_leaks(docs, items, **options).select(
        F.col("row_key").alias(key), F.col("doc_id").alias(doc)).distinct(), "leaky-rows")
    if bad.count() <= BROADCAST_ROWS:  # no text leaves its row here either
        bad = F.broadcast(bad)
    same = (F.xxhash64(docs["doc_id"], docs["text"]) == F.col(key)) & docs["doc_id"].eqNullSafe(F.col(doc))
    return docs.join(bad, same, "left_anti")


def benchmark(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")


@query("op1_template_decontamination")
def op1(spark, sf_dir):
    return find_leaks(c.documents(spark, sf_dir), benchmark(spark, sf_dir)).drop("row_key")
