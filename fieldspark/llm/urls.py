"""URL filters: host rules, word segmentation of hosts by unigram Viterbi, naive Bayes over the segmented tokens.

The unigram model counts the words of all pages' titles, headings and paths (host names are what it splits). Every
distinct name meets the counts of its own substrings by a join, so the vocabulary is whole and a task holds no more
than one name's words. No table labels pages, so rows whose segmented host or path holds a seed word are the positive
examples, every other row a negative one; token counts, odds and the scores of each URL are aggregated and joined by
Spark, over all tokens.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import BROADCAST_ROWS, arrow_map, materialize
from fieldspark.llm.naming import with_names

#: Words of names that sell what a corpus doesn't want: the supervision, a parameter of ``judge``.
SEEDS = ("adult", "bet", "bets", "betting", "casino", "escort", "gambling", "jackpot", "lottery", "malware", "phishing", "pills", "poker", "porn", "sex", "slots", "spam", "viagra", "warez", "win", "xxx")
#: Letters of the longest word of the unigram model; longer words, and those of one letter, are unknown to it.
MAX_WORD = 24
#: Rows of a table of names, words or tokens up to which it is broadcast.
FEW = BROADCAST_ROWS // 4


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; then up to ``?``, ``#`` or the end."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"\A([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def match_rules(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` of the longest rule that fits ``host`` and ``path``, else nulls."""
    fits = [
        F.when(((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))) & F.startswith("path", F.lit(r.path)), F.struct(F.lit(len(r.text)).alias("n"), F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in rules
    ]
    pages = pages.withColumn("__fit", F.greatest(*fits) if len(fits) > 1 else fits[0])
    return pages.withColumns({"rule": F.col("__fit.rule"), "rule_verdict": F.col("__fit.verdict")}).drop("__fit")


def best_split(name: str, logp: dict[str, float], floor: float) -> list[str]:
    """Unigram Viterbi: the split of a name into words of greatest probability; unknown words cost more the longer they are."""
    best, back = [0.0], [0]
    for j in range(1, len(name) + 1):
        options = []
        for i in range(max(0, j - MAX_WORD), j):
            p = logp.get(name[i:j])
            options.append((best[i] + (floor - 2.5 * (j - i) if p is None else p), i))
        score, i = max(options)
        best.append(score)
        back.append(i)
    words, j = [], len(name)
    while j:
        words.append(name[back[j] : j])
        j = back[j]
    return words[::-1]


def counted(df: DataFrame) -> DataFrame:
    """The written table ``df``, marked for broadcast if its counted rows are few."""
    return F.broadcast(df) if df.count() <= FEW else df


def unigrams(pages: DataFrame, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """Rows (w, n): counts of the words of all pages' titles, headings and paths; seed words have the mean at least."""
    _, path = split_url(F.col("url"))
    html = F.coalesce(F.col("html"), F.lit("")) if "html" in pages.columns else F.lit("")
    heads = F.array_join(F.regexp_extract_all(html, F.lit(r"(?is)<(?:title|h1)[^>]*>(.*?)</(?:title|h1)>"), F.lit(1)), " ")
    text = F.concat_ws(" ", path, heads)
    words = pages.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("w")).where(F.length("w").between(2, MAX_WORD))
    counts = materialize(words.groupBy("w").agg(F.count("*").alias("n")), "url-words")
    mean = counts.agg(F.greatest(F.lit(1), F.floor(F.sum("n") / F.count("*")))).first()[0] or 1
    own = pages.sparkSession.createDataFrame([(w, int(mean)) for w in sorted(set(seeds))], "w string, n long")
    return counts.unionByName(own).groupBy("w").agg(F.max("n").alias("n"))


def segments(names: DataFrame, words: DataFrame) -> DataFrame:
    """Rows (name, words array<string>) of the distinct ``names``, split by the counts ``words`` (w, n)."""
    words = materialize(words, "url-unigrams")
    total = max(2, words.agg(F.sum("n")).first()[0] or 0)
    names = names.select("name").distinct()
    at = names.select("name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("i"))
    part = at.select("name", "i", F.explode(F.sequence(F.lit(2), F.least(F.lit(MAX_WORD), F.length("name") - F.col("i") + 1).cast("int"))).alias("k")).where("i + k <= length(name) + 1 AND k > 1")
    found = part.select("name", F.substring(F.col("name"), F.col("i"), F.col("k")).alias("w")).distinct().join(counted(words), "w")
    known = found.groupBy("name").agg(F.collect_list(F.struct("w", "n")).alias("known"))  # at most MAX_WORD a letter of one name

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for name, own in zip(batch.column("name").to_pylist(), batch.column("known").to_pylist(), strict=True):
            out.append(best_split(name, {x["w"]: log(x["n"] / total) for x in own or ()}, -log(total + 1) - 2.0))
        return pa.RecordBatch.from_arrays([batch.column("name"), pa.array(out, pa.list_(pa.string()))], names=["name", "words"])

    return arrow_map(names.join(known, "name", "left"), one, "name string, words array<string>")


def tokenized(urls: DataFrame, words: DataFrame) -> DataFrame:
    """Rows (id, tokens): the segmented words of host labels and path parts of ``urls`` (id, host, path), in order.

    Tokens are marked by where they stand; a run of digits is one token.
    """
    marked = lambda where: lambda x: F.struct(F.lit(where).alias("where"), x.alias("name"))
    runs = lambda text: F.regexp_extract_all(text, F.lit(r"(\p{L}+|\p{Nd}+)"), F.lit(1))
    parts = F.concat(F.transform(runs(F.col("host")), marked("h")), F.transform(runs(F.lower("path")), marked("p")))
    rows = materialize(urls.select("id", F.posexplode(parts)).select("id", "pos", "col.where", "col.name"), "url-parts")
    digits = F.col("name").rlike(r"^\p{Nd}")
    often = rows.where(~digits).groupBy("name").agg(F.count("*").alias("n"))
    split = materialize(segments(often, words).join(often, "name"), "url-segments")
    named = with_names(rows.where(~digits), split, ["name"], FEW).select("id", "pos", F.transform("words", lambda w: F.concat(F.col("where"), F.lit(":"), w)).alias("t"))
    named = named.unionByName(rows.where(digits).select("id", "pos", F.array(F.concat(F.col("where"), F.lit(":#"))).alias("t")))
    return named.groupBy("id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"])).alias("tokens"))


def bayes(rows: DataFrame, alpha: float = 1.0) -> tuple[DataFrame, float, float]:
    """(rows (t, odds, n), odds of a token never seen, prior): multinomial naive Bayes of ``rows`` (tokens, n, blocked).

    Every token of every row counts, ``n`` times.
    """
    sums = lambda c: (F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias("bad"), F.coalesce(F.sum(F.when(~c, F.col("n"))), F.lit(0)).alias("good"))
    n_bad, n_good = rows.agg(*sums(F.col("blocked"))).first()
    counts = materialize(rows.select(F.explode("tokens").alias("t"), "n", "blocked").groupBy("t").agg(*sums(F.col("blocked"))), "url-tokens")
    bad, good, size = counts.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0)), F.count("*")).first()
    bad, good = bad + alpha * (size + 1), good + alpha * (size + 1)
    odds = F.log((F.col("bad") + alpha) / F.lit(bad)) - F.log((F.col("good") + alpha) / F.lit(good))
    return counts.select("t", odds.alias("odds"), (F.col("bad") + F.col("good")).alias("n")), log(alpha / bad) - log(alpha / good) if n_bad else 0.0, log((n_bad + 1) / (n_good + 1))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, seeds: tuple[str, ...] = SEEDS, threshold: float = 0.0) -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict, tokens, score.

    The longest rule that fits decides; else the page is blocked if its log-odds are above ``threshold``. Null URLs
    and ones without ``://`` have empty host and path, no tokens, and the verdict of the prior alone. Rows that share
    a page_id or a URL are judged each on its own, equally; very long names are segmented whole; equal odds block
    nothing; other columns are ignored; an empty table gives an empty table.
    """
    host, path = split_url(F.col("url"))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    urls = materialize(own.groupBy("host", "path").agg(F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id()), "url-distinct")
    tokens = urls.join(tokenized(urls, unigrams(pages, seeds)), "id", "left").withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))
    tokens = materialize(tokens.withColumn("blocked", F.exists("tokens", lambda t: F.substring(t, 3, MAX_WORD + 1).isin(*seeds))), "url-tokenized")
    odds, _, prior = bayes(tokens)
    # every token is in the table of odds; ``h:com`` or ``h:www`` are in nearly every URL
    told = with_names(tokens.select("id", F.explode("tokens").alias("t")), materialize(odds, "url-odds"), ["t"], FEW)
    scores = told.groupBy("id").agg(F.round(F.sum("odds"), 9).alias("sum"))
    scored = tokens.join(scores, "id", "left").select("host", "path", "tokens", (F.lit(prior) + F.coalesce("sum", F.lit(0.0))).alias("score"))
    out = match_rules(own, rules).join(counted(materialize(scored, "url-scores")), ["host", "path"])
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") > threshold, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "tokens", "score")
