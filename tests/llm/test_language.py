import numpy as np

from cellar.llm import language as la

WORDS = {"en": "the of and that house water with which there where".split(),
         "de": "der und nicht schön straße über auch wenn ich ein".split(),
         "fr": "les des pour être très où même dans avec français".split()}


def _text(rng, lang, n=40):
    return " ".join(rng.choice(WORDS[lang], n))


def test_evidence_is_fused(spark):
    rng = np.random.default_rng(2)
    langs = list(WORDS)
    rows, truth = [], {}
    for i in range(300):
        lang = langs[i % 3]
        said = lang if i % 10 else langs[(i + 1) % 3]  # one in ten is declared wrongly
        rows.append((i, _text(rng, lang), said, f"src{i % 4}"))
        truth[i] = lang
    rows += [(400, None, "en", "src0"), (401, "", None, None), (402, "12 34 !!", "de", "src0"), (403, "x" * 100_000, "en", "src1"),
             (404, _text(rng, "de"), None, None), (405, _text(rng, "fr"), "tlh", "new"), (None, _text(rng, "en"), "en", "src0"),
             (0, rows[0][1], rows[0][2], rows[0][3])]
    df = spark.createDataFrame([(*r, "clash", 1.0) for r in rows],
                               "doc_id long, text string, lang string, source string, host string, posterior double")
    got = la.identify(la.document_rows(df)).collect()
    assert len(got) == len(rows)
    by = {r.id: r for r in got}
    assert sum(by[i].language == truth[i] for i in truth) == len(truth)
    assert sum(by[i].kept for i in truth) == len(truth)
    assert by[404].language == "de" and by[405].language == "fr"
    assert not by[400].kept and not by[401].kept and not by[402].kept
    kept = la.keep_identified(df)
    assert kept.columns == df.columns
    left = kept.collect()
    assert {r.doc_id for r in left} >= set(truth) | {404, 405, None} and not {r.doc_id for r in left} & {400, 401, 402}
    assert {r.doc_id: r.lang for r in left}[404] == "de"


def test_held_out_accuracy(spark):
    """A text model fit on even rows names the language of odd rows."""
    docs = la.document_rows(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    names, model = la.train(docs.where("id % 2 = 0"))
    right = total = 0
    from cellar.llm import common as c
    for r in docs.where("id % 2 = 1").collect():
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        bucket, _ = la.trigrams(data, np.array([0, len(data)]))
        if len(bucket) >= 50:
            total += 1
            right += names[int(np.argmax(model[bucket].sum(0)))] == r.declared
    assert total > 300 and right >= 0.95 * total
    assert c.CHUNK_BYTES


def test_pages_and_empty_tables(spark, docs_of):
    pages = spark.createDataFrame(
        [(i, f"https://www.host{i % 3}.de/x", f'<!DOCTYPE html><html lang="de"><script>var the;</script><p>{" ".join(WORDS["de"])}</p>')
         for i in range(30)] + [(99, None, None), (98, "no address", "<p>plain</p>")], "page_id long, url string, html string")
    rows = {r.id: r for r in la.page_rows(pages).collect()}
    assert rows[0].declared == "de" and rows[0].host == "www.host0.de" and rows[0].suffix == "de" and "var" not in rows[0].text
    assert rows[99].host is None and rows[98].declared is None
    assert la.identify(la.page_rows(pages)).where("language = 'de' and kept").count() >= 30
    assert la.identify(la.document_rows(docs_of([]))).count() == 0
    assert not la.identify(la.document_rows(docs_of([(1, "a few words")]))).first().kept


def _codes(n):
    return ["".join(chr(97 + i // 26 ** j % 26) for j in range(3)) for i in range(n)]


def test_rare_languages_are_known(spark):
    """A handful of rows, or a single one, makes a language."""
    rng = np.random.default_rng(5)
    schema = "doc_id long, text string, lang string, source string"
    few = [(i, _text(rng, lang, 60), lang, "s") for i, lang in enumerate(list(WORDS) * 5)]
    got = la.identify(la.document_rows(spark.createDataFrame(few, schema))).collect()
    assert all(r.kept and r.language == r.declared for r in got) and len(got) == 15
    many = [(i, _text(rng, "en", 60), "en", "s") for i in range(300)]
    rare = [(900 + i, _text(rng, "de", 60), "de", "s") for i in range(4)] + [(950, _text(rng, "fr", 200), "fr", "s")]
    wrong = [(990, _text(rng, "en", 60), "xx", "s")]
    df = spark.createDataFrame(many + rare + wrong, schema)
    by = {r.doc_id: r.lang for r in la.keep_identified(df).collect()}
    assert len(by) == 306 and all(by[d] == lang for d, _, lang, _ in many + rare) and by[990] == "en"


def test_more_languages_than_a_pass_holds(spark, monkeypatch):
    """Passes over groups of languages give the result of one pass."""
    rng = np.random.default_rng(6)
    rows = []
    for code in _codes(12):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)]
        rows += [(len(rows) + i, " ".join(rng.choice(words, 40)), code, f"s{i % 2}") for i in range(3)]
    rows += [(900, rows[0][1], None, None), (901, None, "aaa", "s0"), (0, *rows[0][1:])]
    df = la.document_rows(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    key = lambda r: (r.id, r.language, round(r.posterior, 6), r.text_language, r.n_trigrams, r.kept)
    whole = sorted(map(key, la.identify(df).collect()))
    monkeypatch.setattr(la, "GROUP_LANGUAGES", 5)
    assert sorted(map(key, la.identify(df).collect())) == whole
    assert all(r[-1] and r[1] == r[3] for r in whole if r[0] != 901) and len(whole) == len(rows)


def test_rows_do_not_multiply(spark):
    """One doc_id and text with several declared languages and sources, nulls in their turn, and clashing names."""
    rng = np.random.default_rng(6)
    rows = [(i, _text(rng, "en", 60), "en", "s", "x") for i in range(120)]
    same = _text(rng, "de", 60)
    rows += [(500, same, "de", "s", "x"), (500, same, "en", "t", "y"), (500, same, None, "en", "z"), (500, same, "en", None, "z"),
             (500, same, "en", None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _key string")
    df = df.withColumnsRenamed({"_key": "row_key"})
    got = la.keep_identified(df).collect()
    assert len(got) == len(rows) and sum(r.doc_id == 500 for r in got) == 5
