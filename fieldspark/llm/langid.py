"""Language identification: scripts narrow the candidates, Viterbi over per-word scores labels spans.

A word is a run of letters. Its score for a language is the sum of smoothed log-probabilities of its hashed character
n-grams, learned from labelled documents. Only the languages that use a word's script are scored and may label it. A
document's words form a chain with a cost for each switch of language; the best path gives the spans, the language
with most letters the prediction. Where no detour can repay one switch, the best path is the best single language and
needs no chain.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import arrow_map

#: First code points of script ranges in rising order; "" stands for what belongs to no script of its own.
SCRIPTS = (
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, ""), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, ""), (0x0E00, "Thai"),
    (0x0E80, ""), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1380, ""), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, ""),
    (0x3040, "Kana"), (0x3100, ""), (0x3400, "Han"), (0xA000, ""), (0xAC00, "Hangul"), (0xD7B0, ""), (0xF900, "Han"), (0xFB00, ""), (0x20000, "Han"), (0x323B0, ""),
)
STARTS = [a for a, _ in SCRIPTS]
BUCKETS = 1 << 16
SIZES = (1, 2, 3, 4)
#: Words whose scores a worker keeps, longest word kept, and letters of longer ones held before they go.
KEPT, LONG, LONG_LETTERS = 80_000, 64, 1_000_000
LATIN_1 = re.compile("[a-zªµºß-öø-ÿ]+")
ANY = regex.compile(r"\p{L}+")


def script_of(char: str) -> str:
    at = bisect_right(STARTS, ord(char)) - 1
    return SCRIPTS[at][1] if at >= 0 else ""


def lowered(text: str) -> str:
    """Lower-cased, character by character where that would change the length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[0] for c in text)


def pattern(low: str) -> re.Pattern:
    """What finds the runs of letters of a lower-cased text."""
    try:
        low.encode("latin-1")
    except UnicodeEncodeError:
        return ANY
    return LATIN_1


def words_of(text: str | None) -> list[str]:
    low = lowered(text or "")
    return pattern(low).findall(low)


def grams(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size of n-grams: the hashed n-grams of all words, word edges included, and the word of each, rising."""
    joined = "\x02" + "\x02".join(words) + "\x02"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    edge = codes == 2
    owner = np.cumsum(edge, dtype=np.int32) - 1
    h = np.zeros(len(codes), np.uint64)
    inner = np.zeros(len(codes), np.bool_)
    for k in range(1, max(SIZES) + 1):
        n = len(codes) - k + 1
        if n <= 0:
            break
        h = (h[:n] * np.uint64(0x9E3779B97F4A7C15)) ^ (codes[k - 1 :] + np.uint64(k))
        if k > 2:
            inner = inner[:n] | edge[k - 2 : k - 2 + n]
        ok = ~inner[:n] if k > 1 else ~edge
        mixed = (h[ok] * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(40)
        yield (mixed & np.uint64(BUCKETS - 1)).astype(np.int64), owner[:n][ok]


@dataclass
class Model:
    """Log-probabilities of n-gram buckets by language, log priors, and the languages that use each script.

    A script that no language uses narrows nothing: all languages are candidates. A worker keeps scores of words; once
    they are too many, those go that weren't met twice since the last time.
    """

    languages: list[str]
    table: np.ndarray
    prior: np.ndarray
    scripts: dict[str, np.ndarray]
    switch_cost: float = 8.0
    index: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray | None = None
    hits: np.ndarray | None = None
    long_letters: int = 0

    def __getstate__(self):
        return self.__dict__ | {"index": {}, "scores": None, "hits": None, "long_letters": 0}

    def candidates(self, script: str) -> np.ndarray:
        return self.scripts.get(script, np.arange(len(self.languages)))

    def score(self, words: list[str]) -> np.ndarray:
        """Scores of words by language; -inf for languages that aren't candidates."""
        out = np.full((len(words), len(self.languages)), -np.inf, np.float32)
        firsts = np.frombuffer("".join([w[0] for w in words]).encode("utf-32-le", "surrogatepass"), "<u4")
        ranges = np.searchsorted(STARTS, firsts, side="right") - 1
        by_script: dict[str, list[np.ndarray]] = {}
        for r in np.unique(ranges).tolist():
            by_script.setdefault(SCRIPTS[r][1] if r >= 0 else "", []).append(np.flatnonzero(ranges == r))
        for script, parts in by_script.items():
            at, able = np.concatenate(parts), self.candidates(script)
            table = self.table if len(able) == len(self.languages) else self.table[:, able]
            total = np.zeros((len(at), len(able)), np.float64)
            for h, owner in grams([words[i] for i in at.tolist()] if len(at) < len(words) else words):
                if len(h):
                    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                    total[owner[first]] += np.add.reduceat(table[h], first, axis=0)
            out[at[:, None], able] = total
        return out

    def rows(self, words: list[str]) -> np.ndarray:
        """The row of each word in ``scores``; unseen words are scored together."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        new = list(dict.fromkeys([words[i] for i in np.flatnonzero(at < 0).tolist()]))
        if self.scores is None or new and (len(self.index) + len(new) > KEPT or self.long_letters > LONG_LETTERS):
            self.shrink()
            new = [w for w in dict.fromkeys(words) if w not in self.index]
        if new:
            base = len(self.scores)
            self.index.update(zip(new, range(base, base + len(new)), strict=True))
            self.scores = np.concatenate([self.scores, self.score(new)])
            self.hits = np.concatenate([self.hits, np.zeros(len(new), np.int64)])
            self.long_letters += sum(len(w) for w in new if len(w) > LONG)
            at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        self.hits += np.bincount(at, minlength=len(self.hits))
        return at

    def shrink(self) -> None:
        if self.scores is None:
            self.scores, self.hits = np.zeros((0, len(self.languages)), np.float32), np.zeros(0, np.int64)
        names = list(self.index)
        often = np.flatnonzero(self.hits > 1)
        if len(often) > KEPT // 2:
            often = np.sort(often[np.argsort(-self.hits[often], kind="stable")[: KEPT // 2]])
        often = [i for i in often.tolist() if len(names[i]) <= LONG]
        self.index = {names[i]: k for k, i in enumerate(often)}
        self.scores, self.hits, self.long_letters = self.scores[often], np.zeros(len(often), np.int64), 0


def viterbi(scores: np.ndarray, lengths: np.ndarray, prior: np.ndarray, cost: float) -> np.ndarray:
    """Best language of each word for many chains at once; ``scores`` holds the chains one after another.

    Chains are ordered by falling length, so at step t only the first few still run.
    """
    n = scores.shape[1]
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    long = lengths[order]
    steps = int(long[0]) if len(long) else 0
    alive = np.searchsorted(-long, -np.arange(steps), side="left")
    stay = np.zeros((len(scores), n), np.bool_)
    best = np.zeros(len(scores), np.int16)
    d = np.broadcast_to(prior, (len(long), n)).astype(np.float64)
    final = np.zeros(len(long), np.int16)
    for t in range(steps):
        k = alive[t]
        at = starts[:k] + t
        cur = d[:k]
        if t:
            top = cur.argmax(axis=1)
            move = cur[np.arange(k), top] - cost
            best[at] = top
            keep = cur >= move[:, None]
            stay[at] = keep
            cur = np.where(keep, cur, move[:, None])
        d[:k] = cur + scores[at]
        ended = alive[t + 1] if t + 1 < steps else 0
        final[ended:k] = d[ended:k].argmax(axis=1)
    path = np.zeros(len(scores), np.int16)
    state = final.copy()
    for t in range(steps - 1, -1, -1):
        k = alive[t]
        at = starts[:k] + t
        path[at] = state[:k]
        if t:
            s = state[:k]
            state[:k] = np.where(stay[at, s], s, best[at])
    return path


def held_out(doc_id: Column) -> Column:
    """Documents that training never sees: crc32 of the id as text is a multiple of 5 (null ids count as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, max_docs_per_lang: int = 3000, alpha: float = 0.5, switch_cost: float = 8.0) -> Model:
    """Learn from text and non-null lang of the documents that aren't held out.

    At most about ``max_docs_per_lang`` documents of each language are used, chosen by a hash of the id: a bound on
    the training work, not on what is predicted. The counts that reach the driver are bounded by languages x 65,536.
    """
    known = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), {}, switch_cost)
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, max_docs_per_lang / sizes[lang]))])
    drawn = known.where(F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        scripts: dict[tuple[str, str], int] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                if not words:
                    continue
                table = tables.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for i in range(0, len(words), 100_000):
                    for h, _ in grams(words[i : i + 100_000]):
                        table += np.bincount(h, minlength=BUCKETS)
                for w in words:
                    key = (lang, script_of(w[0]))
                    scripts[key] = scripts.get(key, 0) + 1
        rows = [(lang, "", int(b), int(t[b])) for lang, t in tables.items() for b in np.flatnonzero(t)]
        rows += [(lang, script, -1, n) for (lang, script), n in scripts.items()]
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "script", "bucket", "n"])

    counts = drawn.select("lang", "text").mapInArrow(count, "lang string, script string, bucket int, n long")
    counts = counts.groupBy("lang", "script", "bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.full((BUCKETS, len(languages)), alpha)
    words = np.zeros(len(languages))
    used: dict[str, np.ndarray] = {}
    for lang_at, lang in enumerate(languages):
        own = counts[counts.lang == lang]
        g = own[own.bucket >= 0]
        table[g.bucket.to_numpy(np.int64), lang_at] += g.n.to_numpy()
        for script, n in own[own.bucket < 0][["script", "n"]].itertuples(index=False):
            used.setdefault(script, np.zeros(len(languages)))[lang_at] = n
            words[lang_at] += n
    table = np.log(table / table.sum(axis=0)).astype(np.float32)
    scripts = {}
    for script, n in used.items():
        uses = n >= 0.01 * np.maximum(words, 1)
        if script and uses.any():
            scripts[script] = np.flatnonzero(uses)
    prior = np.log(np.array([sizes[lang] for lang in languages], float) / sum(sizes.values()))
    return Model(languages, table, prior, scripts, switch_cost)


SCHEMA = "doc_id long, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def best_single(m: Model, scores: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best single language of each chain (none empty), and whether a path with switches might be better.

    A detour gains at most the largest sum, over a stretch of words, of the best rival's lead, and the priors' spread;
    it costs a switch at least.
    """
    starts = np.cumsum(lengths) - lengths
    lead = (np.add.reduceat(scores, starts, axis=0, dtype=np.float64) + m.prior).argmax(axis=1)
    own, every = np.repeat(lead, lengths), np.arange(len(scores))
    rival = scores.copy()
    rival[every, own] = -np.inf
    with np.errstate(invalid="ignore"):
        ahead = np.nan_to_num(rival.max(axis=1) - scores[every, own], nan=np.inf).astype(np.float64)
    ahead = np.clip(ahead, -m.switch_cost - 1, m.switch_cost + 1)
    after = np.cumsum(ahead) - np.repeat(np.arange(len(lengths)) * (2 * (m.switch_cost + 1) * (len(scores) + 1)), lengths)
    gain = np.maximum.reduceat(after - np.minimum.accumulate(after - ahead), starts)
    return lead, gain + m.prior.max() - m.prior[lead] >= m.switch_cost - 1e-6


def label_group(m: Model, lows: list[str], texts: list[list[str]]) -> list[tuple[str, float, list[dict]]]:
    """(prediction, score, spans) of lower-cased texts and their words, the chains among them all in one Viterbi run."""
    out: list[tuple[str, float, list[dict]]] = [("und", 0.0, [])] * len(lows)
    some = [k for k, p in enumerate(texts) if p]
    if not some:
        return out
    lengths = np.array([len(texts[k]) for k in some], np.int64)
    at = m.rows([w for k in some for w in texts[k]])
    scores = m.scores[at]
    lead, mixed = best_single(m, scores, lengths)
    for k, top in zip(some, lead.tolist(), strict=True):
        out[k] = (m.languages[top], 1.0, [{"start": 0, "end": len(lows[k]), "lang": m.languages[top]}])
    path = viterbi(scores[np.repeat(mixed, lengths)], lengths[mixed], m.prior, m.switch_cost)
    hi = 0
    for k in np.array(some)[mixed].tolist():
        lo, hi = hi, hi + len(texts[k])
        own = path[lo:hi]
        letters = np.bincount(own, weights=[len(w) for w in texts[k]], minlength=len(m.languages))
        begins = [x.start() for x in pattern(lows[k]).finditer(lows[k])]
        cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist()]
        edges = [0, *(begins[c] for c in cuts[1:]), len(lows[k])]
        spans = [{"start": s, "end": e, "lang": m.languages[own[c]]} for c, s, e in zip(cuts, edges[:-1], edges[1:], strict=True)]
        top = int(letters.argmax())
        out[k] = (m.languages[top], float(letters[top] / letters.sum()), spans)
    return out


def label_texts(m: Model, texts: list[str | None], group: int = 250_000) -> list[tuple[str, float, list[dict]]]:
    """(prediction, score, spans) of each text; texts go together until a group has ``group`` words."""
    if not m.languages:
        return [("und", 0.0, [])] * len(texts)
    out: list[tuple[str, float, list[dict]]] = []
    lows: list[str] = []
    words: list[list[str]] = []
    size = 0
    for text in texts:
        lows.append(lowered(text or ""))
        words.append(pattern(lows[-1]).findall(lows[-1]))
        size += len(words[-1])
        if size > group:
            out += label_group(m, lows, words)
            lows, words, size = [], [], 0
    return out + (label_group(m, lows, words) if lows else [])


def label(docs: DataFrame, model: Model) -> DataFrame:
    """One row a document: lang_pred, score (its share of the letters, 0 to 1) and spans (character ranges by language).

    ``und`` with score 0 and no spans if the text is null or has no letter, or nothing was learned. A tie goes to the
    first language in order of name. Spans cover the text; each ends where the next begins. Rows that share a doc_id
    are labelled each on its own; other columns are ignored; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        preds, scores, spans = zip(*label_texts(shared.value, batch.column("text").to_pylist()), strict=True)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, SPANS)], names=["doc_id", "lang_pred", "score", "spans"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), one, SCHEMA)


def identify(docs: DataFrame, max_docs_per_lang: int = 3000) -> DataFrame:
    """Train on the labelled documents that aren't held out, then label all: doc_id, held_out, lang_pred, score, spans.

    Null and empty texts, rows that share a doc_id, very long texts and an empty table are treated as in ``label``; a null
    doc_id counts as empty text for held_out; other columns are ignored.
    """
    out = label(docs, train(docs, max_docs_per_lang))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "spans")


def keep_identified(docs: DataFrame, min_score: float = 0.4, max_docs_per_lang: int = 3000) -> DataFrame:
    """The rows of ``docs`` whose text has letters, at least ``min_score`` of them in one language; columns stay.

    Null and empty texts go. Rows that share a doc_id are judged each on its own; null ids are judged like others;
    an empty table stays empty, and if nothing can be learned all rows go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, max_docs_per_lang))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = label_texts(shared.value, batch.column(batch.schema.get_field_index("text")).to_pylist())
        return batch.filter(pa.array([pred != "und" and score >= min_score for pred, score, _ in found], pa.bool_()))

    return arrow_map(docs, one, docs.schema)
