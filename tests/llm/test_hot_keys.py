"""The ways beyond the broadcast bounds, with the bounds lowered: one key of most rows changes no result."""

import pytest

from fieldspark.llm import lines, naming, packing, simhash, token_counts, urls


@pytest.fixture
def low(monkeypatch):
    monkeypatch.setattr(naming, "FEW_NAMES", 5)
    monkeypatch.setattr(naming, "HUB_ROWS", 20)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_fingerprints_of_most_documents(spark, low, monkeypatch):
    rows = [(i, "the same text in very many documents") for i in range(90)] + [(100 + i, f"w{i} x{i} y{i} z{i} q{i}") for i in range(40)] + [(None, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(simhash.near_duplicates(df))
    monkeypatch.setattr(naming, "FEW_NAMES", 100_000)
    assert got == rows_of(simhash.near_duplicates(df)) and len(got) == len(rows)


@pytest.mark.parametrize("many", [0, 20_000])
def test_lines_of_most_documents(spark, monkeypatch, many):
    common, other = "a line that nearly every document has", "another long line of a few documents"
    rows = [(i, "\n".join([common, f"own line number {i} of this", *([other] if i % 9 == 0 else [])])) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = rows_of(lines.line_dedup(df))
    for name, value in (("CONFIRMED", 0), ("HUB_ROWS", 20), ("MANY_HUBS", many)):
        monkeypatch.setattr(lines, name, value)
    assert rows_of(lines.line_dedup(df)) == want


def test_tokens_of_most_urls(spark, low, monkeypatch):
    rows = [(i, f"https://www.site{chr(97 + i % 9)}.com/{'casino' if i % 7 == 0 else 'garden'}/item{i % 30}", "<title>garden item casino site</title>") for i in range(120)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(urls, "FEW", 3)
    got = rows_of(urls.judge(df))
    monkeypatch.setattr(urls, "FEW", 250_000)
    assert got == rows_of(urls.judge(df)) and any("block" in r for r in got)


def test_pretokens_by_corpus_or_worker(spark):
    path = packing.vocabulary("piece_bpe_32k.model")
    word = "unbelievably" * 40
    rows = [(i, f"the same words again, {'token ' * (i % 5)}and w{i} größe 北京{i % 7}") for i in range(150)] + [(900, word), (901, f"{word} {word}"), (901, None), (None, "  ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = rows_of(token_counts.token_counts(df, path, frequent=0))
    for frequent, repeats in ((3, 1), (20, 2), (1_000, 1), (250_000, 4)):
        assert rows_of(token_counts.token_counts(df, path, frequent, repeats)) == want
    assert len(want) == len(rows)


def test_frequent_words_by_classes_of_counts(spark):
    counts = {f"w{i}": 1 + 1000 // (i + 1) for i in range(300)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    for most in (0, 1, 10, 120, 299, 300, 5_000):
        words, n = token_counts.most_frequent(df, most)
        got = {r.word for r in words.collect()}
        assert len(got) == n <= most
        assert min((counts[w] for w in got), default=10**6) > max((c for w, c in counts.items() if w not in got), default=0)
    assert n == 300 and token_counts.most_frequent(df.limit(0), 5)[1] == 0


def test_walk_goes_on_between_batches_and_long_words_go():
    pieces = {"▁a": -1.0, "▁": -3.0, "b": -2.0, "ab": -2.5, "a": -4.0}
    words = sorted(["a", "ab", "aab", "abba", "abb", "b", "bab", "x"])
    trie = token_counts.ForwardTrie(pieces)
    ends = [e for part in (words[:3], words[3:4], words[4:]) for e in trie.walk(part)]
    assert ends == [next(token_counts.ForwardTrie(pieces).walk([w])) for w in words]
    long = "ab" * token_counts.LONG
    trie.insert({long, "ab"})
    assert trie.found([long, "ab"])[1] == ends[words.index("ab")] and long in trie.terminal
    trie.insert({"b"})
    assert set(trie.terminal) == {"ab", "b"} and trie.found(["b"])
