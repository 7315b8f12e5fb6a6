"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldspark.llm import chat, decontam, langid, lines, lm_scoring, neardup, packing, quality, simhash, token_counts, urls

LONG = "a long line of words that goes on\n" * 3 + "wort " * 60_000
ROWS = [
    (1, "the cat sat on the mat and the dog ran off", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, " \t\n ", "de"),
    (5, "der hund und die katze sind im haus und der garten", "de"),
    (5, "der hund und die katze sind im haus und der garten", "de"),
    (None, "the cat sat on the mat and the dog ran off", None),
    (None, None, None),
    (6, LONG, "de"),
    (7, "\u00dcber \U0001f600 \u4f60\u597d \u0000 x\u00a0y", "en"),
    (8, "12 34 !!", "en"),
]
CLASH = ("line_count", "line_dropped", "key", "h", "w", "fp", "piece", "length", "__gone_id", "__drop_id", "label", "found_id", "items", "src", "bucket", "n_words", "score", "kept")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.lit(1) for c in CLASH})


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "the cat sat on the mat and the dog"), (2, None), (3, ""), (4, "two words"), (None, "the cat sat on the mat")], "item_id long, text string")


def operators(items):
    path = packing.vocabulary("word_bpe_49k.json")
    return {
        "identify": (langid.identify, "rows"),
        "keep_identified": (langid.keep_identified, "filter"),
        "pack": (lambda d: packing.pack(d, path, 64), None),
        "near_duplicates": (simhash.near_duplicates, "rows"),
        "keep_first": (simhash.keep_first, "filter"),
        "token_counts": (lambda d: token_counts.token_counts(d, packing.vocabulary("piece_bpe_32k.model")), "rows"),
        "lm_scores": (lm_scoring.lm_scores, "rows"),
        "ledger": (quality.ledger, "rows"),
        "line_dedup": (lines.line_dedup, "rows"),
        "find_leaks": (lambda d: decontam.find_leaks(d, items), None),
        "drop_leaks": (lambda d: decontam.drop_leaks(d, items), "filter"),
        "near_copies": (neardup.near_copies, None),
        **{f"stage {name}": ((lambda d, f=f: f(d.sparkSession, d, "/root/testdata/sf0.001")), "rows" if name == "line_dedup" else None if name == "packing" else "filter") for name, f in corpus_pipeline.STAGES},
    }


NAMES = list(operators(None))


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(docs, items, name):
    op, kind = operators(items)[name]
    out = op(docs)
    rows = out.collect()
    if kind == "rows":
        assert len(rows) == len(ROWS)
    if kind == "filter":
        assert out.columns == docs.columns and 0 < len(rows) <= len(ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_and_null_tables(docs, items, name):
    op, _ = operators(items)[name]
    assert op(docs.where("false")).count() == 0
    nulls = docs.limit(2).select(*[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes])
    op(nulls).collect()


def test_null_texts_have_their_defined_results(docs, items):
    of = lambda df: {r.doc_id: r for r in df.where("doc_id IN (2, 3, 4, 8)").collect()}
    lang = of(langid.identify(docs))
    assert all(lang[i].lang_pred == "und" and lang[i].score == 0 for i in (2, 3, 4, 8))
    fps = of(simhash.near_duplicates(docs))
    assert all((fps[i].fp, fps[i].component_id) == (0, 2) for i in (2, 3, 4))
    led = of(quality.apply_policy(quality.ledger(docs)))
    assert all(led[i].n_words == 0 and led[i].base_failed and not led[i].kept for i in (2, 3, 4))
    lm = of(lm_scoring.lm_scores(docs))
    assert all(lm[i].log_score == 0 and lm[i].mean_log_score is None for i in (2, 3, 4))
    packed = packing.pack(docs).where("doc_id IN (2, 3, 4)").collect()
    assert [r.length for r in packed] == [1, 1, 1]


def test_stages_keep_columns_and_null_ids(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
        assert out.where("doc_id IS NULL").count() == (1 if name == "language_id" else 2)
    near = {r.doc_id: r.component_id for r in neardup.near_copies(docs).collect()}
    assert near == {1: 1, 2: 2, 3: 2, 4: 2, 5: 5, 6: 6, 7: 7, 8: 8}


def test_toxic_words_of_nothing(spark, docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (5, None), (None, 1), (6, 0)], "doc_id long, toxic int")
    assert quality.toxic_words(docs, labels) == () and quality.toxic_words(docs, labels.where("false")) == ()
    many = spark.createDataFrame([(i, "Bad, words here" if i < 5 else "words Here") for i in range(9)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i < 5)) for i in range(9)], "doc_id long, toxic int")
    assert quality.toxic_words(many, marks) == ("bad",)
    one = {r.doc_id: r.n_toxic for r in quality.ledger(many, ("bad", "none")).collect()}
    assert one == {i: int(i < 5) for i in range(9)}


def test_leaks_of_edges(docs, items):
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, items).collect()} == {(1, 1)}
    kept = {r.doc_id for r in decontam.drop_leaks(docs, items).collect()}
    assert kept == {None, 2, 3, 4, 5, 6, 7, 8}
    assert decontam.find_leaks(docs, items.where("false")).count() == 0


def test_pages(spark):
    rows = [(1, None, None), (2, "no scheme", ""), (3, "HTTP://A.Example.ORG/es/1?x#y", "<title>a b</title>"), (3, "x://org", None), (None, "https://free-casino.net", ""), (5, "x://Com/fr/", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit(1), "path": F.lit(1), "rule": F.lit(1)})
    out = {r.page_id: r for r in urls.judge(df).where("page_id IS NULL OR page_id <> 3").collect()}
    assert (out[1].host, out[1].path, out[1].rule, out[1].tokens) == ("", "", None, [])
    assert out[5].rule == "com/fr/" and out[5].verdict == "allow"
    assert out[None].verdict == "block"
    three = urls.judge(df).where("page_id = 3").orderBy("host").collect()
    assert [(r.host, r.path, r.rule) for r in three] == [("a.example.org", "/es/1", "example.org/es/"), ("org", "", None)]
    assert urls.judge(df.where("false")).count() == 0


def test_conversations(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "a"), (1, 0, None, "a"), (None, None, None, None), (2, 0, "assistant", "x\\<|end|>\n</s>" * 50)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"chunk": F.lit(1), "spans": F.lit(1)})
    out = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df, chunk_chars=37)).collect()}
    assert {k: r.n_turns for k, r in out.items()} == {1: 3, 2: 1, None: 1}
    assert out[2].loss_chars == 50 * len("x\\<|end|>\n</s>") and out[1].loss_chars == 0
    assert chat.read_back(chat.format_conversations(df.where("false"))).count() == 0
