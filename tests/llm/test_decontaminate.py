import random
import re

import pytest
from pyspark.sql import functions as F

from cellar.llm import decontaminate as dc

ITEM = ("Anna has 12 apples and Ben gives Anna 5 apples more at the market, "
        "so how many apples does Anna now have in total?")


def tokens(spark, text):
    return spark.createDataFrame([(text,)], "text string").select(dc.template_tokens(F.col("text"))).first()[0]


def test_template_tokens(spark):
    t = tokens(spark, "The car of Maria drove 12.5 km, and paid $3 (50%) there.")
    assert t == ["the", "car", "of", "\u0002maria", "drove", "\u000312.5", "\u0004unitkm", "and", "paid", "\u0004money",
                 "\u00033", "\u000350", "\u0004unit", "there"]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, ITEM), (2, "short item"), (3, None), (4, "one two three four five six seven eight nine ten"),
                                  (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu")],
                                 "item_id long, text string")


def found(docs, items):
    return {(r.doc_id, r.item_id): r for r in dc.find_leaks(docs, items).collect()}


def test_copies_and_new_parameters(spark, docs_of, items):
    again = ITEM.replace("Anna", "Zoe").replace("Ben", "Tom").replace("12", "31").replace("5", "44")
    broken = again.replace("so how many apples does Zoe", "so how many apples does Kim")
    fill = "some other words stand here before the question begins. "
    got = found(docs_of([
        (10, fill + ITEM + " And more."), (11, fill + again), (12, fill + broken), (13, fill * 3), (14, None), (15, ""),
        (16, "alpha beta gamma delta epsilon zeta"), (17, "ALPHA BETA, gamma delta epsilon (zeta) eta theta iota kappa lambda mu"),
        (18, "w " * 30_000 + ITEM), (19, ITEM), (19, ITEM), (None, ITEM)]), items)
    assert {d for d, _ in got} == {10, 11, 17, 18, 19, None} | ({12} & {d for d, _ in got})
    assert got[10, 1].n_changed == 0 and got[10, 1].n_windows == got[10, 1].item_windows
    # the first word of a sentence is no name, so the window with the other "Anna" differs
    assert got[11, 1].n_changed > 0 and got[11, 1].n_windows == got[11, 1].item_windows - 1
    assert (12, 1) not in got or got[12, 1].n_windows < got[12, 1].item_windows
    assert got[17, 5].n_changed == 0
    kept = dc.decontaminate(docs_of([(10, ITEM), (13, fill), (14, None), (None, ITEM), (None, "x")]), items)
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(13, fill), (14, None), (None, "x")}
    assert kept.columns == docs_of([]).columns


def test_empty_tables(spark, docs_of, items):
    assert dc.find_leaks(docs_of([]), items).count() == 0
    assert dc.find_leaks(docs_of([(1, ITEM)]), items.limit(0)).count() == 0


def test_against_brute_force(spark):
    """On the small tables: the pairs with three common 8-word windows."""
    d = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    win = lambda t: [tuple(w[i:i + 8]) for w in [words(t)] for i in range(len(w) - 7)]
    items = {r.item_id: win(r.text) for r in bench.collect()}
    want = set()
    for r in docs.collect():
        mine = set(win(r.text))
        want |= {(r.doc_id, i) for i, w in items.items() if w and sum(x in mine for x in w) >= min(3, len(w))}
    assert set(found(docs, bench)) == want and want


def test_short_and_dense_items(spark, docs_of):
    """Copies of items shorter than a window, or with more slots than a template may have."""
    short, dense = "What is the capital of France?", "Compute 12 + 34 + 56 + 78 + 90 + 11 + 25"
    items = spark.createDataFrame([(1, short), (2, dense), (3, "Yes"), (4, "?!")], "item_id long, text string")
    fill = "some other words stand here before the question begins. "
    got = found(docs_of([(10, fill + short + " Paris."), (11, fill + dense), (12, short), (13, dense.replace("34", "35")),
                         (14, "What is the capital of Spain?"), (15, fill), (16, "the capital of France"),
                         (17, "Oh yes it is"), (18, "Is it?\n yes! \nIt is.")]), items)
    assert set(got) == {(10, 1), (12, 1), (11, 2), (18, 3)}
    assert all(r.n_windows == r.item_windows == 1 and r.n_changed == 0 for r in got.values())


def test_names_at_sentence_starts(spark, docs_of):
    """Both readings of sentence-initial words join, at any line ends."""
    people = "Anna has 12 apples. Ben has 5 pears. Carl buys 7 plums. How many fruits are there?"
    items = spark.createDataFrame([(1, people), (2, "Anna has 12 apples. Where are they all now?"), (3, ITEM)],
                                  "item_id long, text string")
    other = people.replace("Anna", "Zoe").replace("Ben", "Tom").replace("Carl", "Kim").replace("12", "9")
    got = found(docs_of([(10, "Here it is. " + other), (11, "Zoe has 3 apples. Where are they all now?"),
                         (12, ITEM.replace(" Ben", "\nBen").replace(" Anna", "  Anna")),
                         (13, "Zoe had no apples. Tom ate pears. Kim sold plums.")]), items)
    assert set(got) == {(10, 1), (11, 2), (12, 3)}
    assert got[10, 1].n_changed == 4 and got[11, 2].n_changed == 2
    assert got[12, 3].n_windows == got[12, 3].item_windows and got[12, 3].n_changed == 0


def test_positions_count_once_and_names_stay_apart(spark, docs_of):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    people = ("We saw Anna, Ben, Carl and Dora at the fair, where Anna paid 3 coins for Ben "
              "and Carl paid 4 coins for Dora, so who paid more?")
    items = spark.createDataFrame([(1, item), (2, people)], "item_id long, text string")
    one_window = " and then ".join(["beta gamma delta epsilon zeta eta theta iota"] * 3)
    everyone = people
    for name in ("Anna", "Ben", "Carl", "Dora"):
        everyone = everyone.replace(name, "Zoe")
    swapped = people.replace("Anna", "Eva").replace("Carl", "Finn").replace("3 coins", "4 coins")
    got = found(docs_of([(10, one_window), (11, item + ". " + item), (12, everyone), (13, swapped)]), items)
    assert set(got) == {(11, 1), (13, 2)}
    assert got[11, 1].n_windows == got[11, 1].item_windows == 5
    assert got[13, 2].n_windows == got[13, 2].item_windows and got[13, 2].n_changed == 3


def test_columns_with_clashing_names(spark, items):
    docs = spark.createDataFrame([(1, ITEM, 5, "a", 7), (2, "clean", 6, None, 8)],
                                 "doc_id long, text string, _bad long, row_key string, bad_doc long")
    assert [tuple(r) for r in dc.decontaminate(docs, items).collect()] == [(2, "clean", 6, None, 8)]


def _brute_force(tokens, items):
    """The same rules over token lists, with every window of every document looked at."""
    def window(marked, p, n, reading):
        key, slots = [], []
        for t in marked[p:p + n]:
            kind, bare = t[0], t[1:]
            if reading == dc.EXACT:
                key.append(bare if kind <= "\u0005" else t)
            elif kind < "\u0005" or (kind == "\u0005" and reading == dc.NAMES):
                kind = "\u0002" if kind == "\u0005" else kind
                key.append(kind)
                slots.append(kind + bare)
            else:
                key.append(bare if kind == "\u0005" else t)
        return (tuple(key), reading == dc.EXACT), (None if reading == dc.EXACT else tuple(slots))

    def readings(marked, p):
        a, b = window(marked, p, 8, dc.WORDS), window(marked, p, 8, dc.NAMES)
        return [(dc.WORDS, *a)] + ([(dc.NAMES, *b)] if a[0] != b[0] else [])

    def of_item(marked):
        if len(marked) < 8:
            return [(0, dc.EXACT, *window(marked, 0, len(marked), dc.EXACT))] if len(marked) >= dc.MIN_INSIDE else []
        out = []
        for p in range(len(marked) - 7):
            here = readings(marked, p)
            out += [(p, *w) for w in here if len(w[2]) <= dc.MAX_SLOTS]
            if any(len(w[2]) > dc.MAX_SLOTS for w in here):
                out.append((p, dc.EXACT, *window(marked, p, 8, dc.EXACT)))
        return out

    def steady(pairs):
        names = [d for _, d in pairs if d[0] == "\u0002"]
        return len({i for i, _ in pairs}) == len(pairs) and len(set(names)) == len(names)

    want = set()
    for item, marked in items:
        mine = of_item(marked)
        every, template = {w[0] for w in mine}, {w[0] for w in mine if w[1] == dc.WORDS}
        for doc, text in tokens:
            lines = {}
            for p in range(len(text)):
                here = readings(text, p) if p + 8 <= len(text) else []
                here += [(dc.EXACT, *window(text, p, n, dc.EXACT)) for n in range(4, 9) if p + n <= len(text)]
                for reading, key, slots in here:
                    for q, item_reading, item_key, item_slots in mine:
                        if key == item_key:
                            pairs = set(zip(item_slots, slots)) if slots is not None else set()
                            lines.setdefault(p - q, []).append((q, reading, item_reading, pairs))
            t, n, a = set(), set(), set()
            for line in lines.values():
                plain = [w for w in line if w[1] == w[2] != dc.NAMES]
                plain_ok = steady(set().union(*[w[3] for w in plain])) if plain else True
                any_ok = steady(set().union(*[w[3] for w in line]))
                if plain_ok:
                    t |= {w[0] for w in plain if w[1] == dc.WORDS}
                    n |= {w[0] for w in plain}
                if any_ok or plain_ok:
                    a |= {w[0] for w in (line if any_ok else plain)}
            enough = lambda x, of: of and len(x) >= min(dc.MIN_WINDOWS, len(of))
            alone = enough(t, template) or enough(n, every)
            if alone or enough(a, every):
                want.add((doc, item, len(n) if alone else len(a), len(every)))
    return want


def test_slots_against_brute_force(spark, docs_of):
    rng = random.Random(5)
    words = "the a sees gives buys near old red apples coins so how many in all at of".split()
    name = lambda: rng.choice(["Anna", "Ben", "Carl", "Dora", "Zoe"])
    def text(n):
        out = [rng.choice([rng.choice(words), rng.choice(words), rng.choice(words), name(), str(rng.randint(1, 9)),
                           f"{rng.randint(1, 9)} km", "The", "old."]) for _ in range(n)]
        return " ".join(out)
    items = [(i, text(rng.choice([4, 6, 9, 14, 25]))) for i in range(12)]
    def again(t):
        swap = dict(zip(["Anna", "Ben", "Carl", "Dora", "Zoe"], rng.choices(["Kim", "Lea", "Max", "Ned", "Pia", "Anna"], k=5)))
        t = " ".join(swap.get(w, w) for w in t.split(" "))
        return t if rng.random() < .5 else re.sub(r"\d", lambda m: str(rng.randint(1, 9)), t)
    docs = []
    for i in range(120):
        parts = [text(rng.randint(0, 9))]
        for _ in range(rng.randint(0, 2)):
            t = again(rng.choice(items)[1]).split(" ")
            if rng.random() < .3:
                t.insert(rng.randrange(len(t)), "very")
            lo = rng.choice([0, 0, rng.randrange(len(t))])
            parts += [" ".join(t[lo:]), text(rng.randint(0, 9))]
        docs.append((i, " ".join(parts)))
    frame = spark.createDataFrame(items, "item_id long, text string")
    marked = lambda df, key: [tuple(r) for r in df.select(key, dc._marked_tokens(F.col("text"))).collect()]
    want = _brute_force(marked(docs_of(docs), "doc_id"), marked(frame, "item_id"))
    got = dc.find_leaks(docs_of(docs), frame).collect()
    assert {(r.doc_id, r.item_id, r.n_windows, r.item_windows) for r in got} == want and len(want) > 30
    assert len({(d, i) for d, i, n, of in want if n < of}) > 5


def test_marks_are_told_by_bytes(spark):
    """The marks of tokens, told as ``ascii`` tells them, without a new string for each token."""
    odd = ["", "a", "\u0002ann", "\u0003", "\u00034", "\u0004unit", "\u0005one", "\u0005", "\u0006", "é", "é", "😀", "漢", "0", None]
    df = spark.createDataFrame([(x,) for x in odd], "x string")
    x, n = F.col("x"), F.ascii("x")
    assert df.where(~dc._below(x, 5).eqNullSafe(n < 5) | ~dc._below(x, 6).eqNullSafe(n <= 5) | ~dc._is_start(x).eqNullSafe(n == 5)).count() == 0
    hashed = df.where(n > 5).select(*[dc._token_hash(r)(x).alias(f"h{r}") for r in (dc.WORDS, dc.NAMES, dc.EXACT)])
    assert hashed._jdf.queryExecution().optimizedPlan().toString().count("ascii(x") <= 1 + 2  # slots alone, and the filter here
    assert hashed.where((F.col("h0") != F.col("h1")) | (F.col("h0") != F.col("h2"))).count() == 0


def test_documents_are_not_shuffled(spark, docs_of, items):
    """The keys of the documents that go are sent to the documents, not the texts to the keys."""
    kept = dc.decontaminate(docs_of([(10, ITEM), (13, "none of it"), (14, None)]), items)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert {r.doc_id for r in kept.collect()} == {13, 14}
