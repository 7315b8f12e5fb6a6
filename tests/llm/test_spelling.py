"""Spelling variants against all pairs compared, with split buckets, ties, chains and odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldspark.llm import spelling


def one_edit(a, b):
    """Whether one inserted, deleted or replaced code point makes one of the other, by trying all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(counts, ratio=5):
    out = {}
    for w, n in counts.items():
        near = [x for x in counts if one_edit(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = (n, len(near), form, counts[form] if form else None)
    roots = {}
    for w in out:
        r = w
        while out[r][2]:
            r = out[r][2]
        roots[w] = r
    return {w: (*v, roots[w]) for w, v in out.items()}


def plain_counts(rows, every):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def found(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def some_words(seed, n, alphabet="abÄ"):
    rnd = random.Random(seed)
    return sorted({"".join(rnd.choice(alphabet) for _ in range(rnd.choice([6, 6, 7, 7, 8, 12]))) for _ in range(n)})


@pytest.mark.parametrize("block, together", [(5, 1), (40, 30), (2000, 64)])
def test_near_words_are_all_pairs(spark, monkeypatch, block, together):
    monkeypatch.setattr(spelling, "TOGETHER", together)
    words = [(w, 1 + i % 7) for i, w in enumerate(some_words(1, 300))]
    df = spark.createDataFrame(words, "word string, n long")
    met = {r.word: (r.n_near, r.best_n, r.best_word) for r in spelling.near_words(df, block).collect()}
    counts = dict(words)
    for w in counts:
        near = [x for x in counts if one_edit(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        assert met.get(w) == ((len(near), counts[best], best) if near else None)


def test_whole_rule_with_planted_misspellings(spark):
    rnd = random.Random(2)
    words = some_words(3, 60, "abcÀ")
    rows = [(i, " ".join(rnd.choices(words, weights=[1 + (k % 9) ** 3 for k in range(len(words))], k=200)).title()) for i in range(40)] + [(None, "Abcabc " * 9)]
    out = found(spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), every=7))
    assert out == plain_forms(plain_counts(rows, 7)) and any(v[2] for v in out.values())


def test_chains_and_ties(spark):
    counts = {"abcdef": 5, "abcdeg": 25, "abcdgg": 125, "abcggg": 625, "zzzzzz": 25, "zzzzzy": 5, "zzzzyz": 25, "zzzzyy": 5}
    text = " ".join(w for w, n in counts.items() for _ in range(n))
    out = found(spelling.spelling_variants(spark.createDataFrame([(1, text)], "doc_id long, text string")))
    assert out == plain_forms(counts)
    assert out["abcdef"][4] == "abcggg" and out["zzzzyy"][2] == "zzzzyz"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abé𝄞", min_size=1, max_size=6), min_size=2, max_size=14, unique=True), st.integers(1, 7), st.booleans())
def test_tiles_find_single_edits_once(words, longer, by_suffix):
    at = np.arange(len(words))
    seen = Counter((min(a, b), max(a, b)) for x, y in spelling.near_in_tile(words, at * 0, at, at, longer, by_suffix) for a, b in zip(x, y, strict=True))
    half = longer // 2

    def prefix(a, b):
        return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    want = {(i, j) for j in range(len(words)) for i in range(j) if max(len(words[i]), len(words[j])) == longer and one_edit(words[i], words[j]) and (prefix(words[i], words[j]) >= half) != by_suffix}
    assert set(seen) == want and set(seen.values()) <= {1}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n12 "), (None, "letter " * 5), (4, "letter " * 30), (4, "letter " * 30), (5, ("w" * 100_000 + " ") * 6), (6, ("w" * 99_999 + " ") * 5), (7, "leTTers " * 5), (8, "×÷×÷×÷ " * 5), (9, "LÄNGER länger lÄnger " * 5), (10, "Ãlphaβet " * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("word", "n", "root", "form", "bucket", "tile", "part", "count")})
    out = found(spelling.spelling_variants(df))
    assert out == plain_forms(plain_counts(rows, 0))
    assert out["letters"][2] == "letter" and out["w" * 99_999][1] == 1
    assert spelling.spelling_variants(df.where("false")).count() == 0
