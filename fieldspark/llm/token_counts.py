"""Token counts by a unigram model, with forward scores shared along a trie of pre-tokens.

A pre-token is a run of text between ASCII white space, marked as a word start. Its tokens are the pieces of the best
unigram segmentation. Distinct pre-tokens are the paths of a trie, walked depth first: a node stands for a prefix, and
its forward score (the best score of any segmentation of that prefix, and how many pieces it has) is computed once from
its ancestors, however many pre-tokens share the prefix. In sorted order the open path is all of the trie that is ever
needed. A terminal node's count is the pre-token's and is stored.

The frequent pre-tokens of the corpus, nearly all occurrences, are one trie: sorted into ranges, each walked by a task,
their terminals a table that every worker gets (its rows and their length are bounded). The others are too many to be
joined back and share little: a worker walks the trie of those it meets. Which way a pre-token takes changes no result.

The tokenizer's pieces are as its file has them. Their probabilities are those of a unigram model of the corpus: how
often the public tokenizer itself gives each piece over all documents.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import arrow_map, free_memory, materialize

#: Terminals that a worker keeps in each of two generations, and distinct pre-tokens that are counted at once.
TERMINALS, COUNTED = 100_000, 200_000
#: Pre-tokens of the corpus-wide trie at most, the repeats among COUNTED that propose one, pre-tokens of a task that walks it.
FREQUENT, REPEATS, WALKED = 250_000, 4, 10_000
#: Characters of a pre-token from which its terminal isn't kept.
LONG = 100
START = "▁"
COUNTS = pa.schema([("piece", pa.int32()), ("word", pa.string()), ("n", pa.int64())])


@lru_cache(maxsize=1)
def tokenizer(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def corpus_counts(docs: DataFrame, path: str, repeats: int = REPEATS) -> DataFrame:
    """Rows (piece int, word string, n long) of all texts' pre-tokens: how often the tokenizer at ``path`` gives each piece (word null), and repeated pre-tokens (piece null).

    A pre-token is counted where a task meets it ``repeats`` times among ``COUNTED`` distinct ones; the pieces are complete.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(path)
        total = np.zeros(model.get_piece_size(), np.int64)
        words: Counter[bytes] = Counter()

        def count() -> pa.RecordBatch:
            names = [w.decode() for w in words]
            ids = model.encode(names)
            times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), [len(x) for x in ids])
            np.add.at(total, np.fromiter((i for x in ids for i in x), np.int64, len(times)), times)
            again = [(w, n) for w, n in zip(names, words.values(), strict=True) if n >= repeats and len(w) <= LONG]
            words.clear()
            return pa.RecordBatch.from_pylist([{"piece": None, "word": w, "n": n} for w, n in again], schema=COUNTS)

        for batch in batches:
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words.update((text or b"").split())
                if len(words) > COUNTED:
                    yield count()
        if words:
            yield count()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.nulls(len(some), pa.string()), pa.array(total[some])], schema=COUNTS)

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "piece int, word string, n long")
    return rows.groupBy("piece", "word").agg(F.sum("n").alias("n"))


def piece_scores(path: str, counts: dict[int, int]) -> dict[str, float]:
    """Log-probabilities of a SentencePiece file's pieces by their ``counts`` plus one; control pieces are left out."""
    model = tokenizer(path)
    used = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    total = log(sum(counts.get(i, 0) + 1 for i in used) or 1)
    return {model.id_to_piece(i): log(counts.get(i, 0) + 1) - total for i in used}


class ForwardTrie:
    """Best (pieces, score) of pre-tokens, by forward scores along the paths of their trie.

    A character that no piece covers falls back to its UTF-8 bytes, each a token of ``byte_score``. Of equal scores
    the one with fewer pieces counts. ``known`` terminals are taken as they are. Once the own terminals are full they
    become the old ones, of which those stay that are asked for again, and long ones stay for one call, so memory is bounded.
    """

    def __init__(self, pieces: dict[str, float], byte_score: float | None = None, known: dict[str, tuple[int, float]] | None = None):
        self.pieces = pieces
        #: Ends of pieces: a text that none of them is can be no piece's end, however far it goes back.
        self.ends = {p[i:] for p in pieces for i in range(len(p))}
        self.byte_score = min(pieces.values(), default=0.0) - 10.0 if byte_score is None else byte_score
        self.known = known or {}
        self.terminal: dict[str, tuple[int, float]] = {}
        self.old: dict[str, tuple[int, float]] = {}
        self.long: list[str] = []
        #: The open path: its text, and the scores and numbers of pieces of its prefixes.
        self.before, self.scores, self.counts = "", [0.0], [0]

    def walk(self, words: Iterable[str]) -> Iterator[tuple[int, float]]:
        """(pieces, score) of each of ``words``; a prefix that it shares with the word before isn't scored again."""
        pieces, ends, low, scores, counts = self.pieces, self.ends, self.byte_score, self.scores, self.counts
        for word in words:
            text, before = START + word, self.before
            d, n = 0, min(len(text), len(before))
            while d < n and text[d] == before[d]:  # the shared prefix
                d += 1
            del scores[d + 1 :], counts[d + 1 :]
            for d in range(d + 1, len(text) + 1):
                best, count = None, 0
                for i in range(d - 1, -1, -1):
                    end = text[i:d]
                    p = pieces.get(end)
                    if p is not None:
                        s, c = scores[i] + p, counts[i] + 1
                        if best is None or s > best or s == best and c < count:
                            best, count = s, c
                    elif end not in ends:
                        break
                n_bytes = len(text[d - 1].encode())
                s, c = scores[d - 1] + n_bytes * low, counts[d - 1] + n_bytes
                if best is None or s > best or s == best and c < count:
                    best, count = s, c
                scores.append(best)
                counts.append(count)
            self.before = text
            yield counts[-1], scores[-1]

    def insert(self, words: set[str]) -> None:
        """Makes terminals of the words that are none yet, each node of their trie once."""
        for word in self.long:
            del self.terminal[word]
        if len(self.terminal) > TERMINALS:
            self.old, self.terminal = self.terminal, {}
        words = words - self.known.keys() - self.terminal.keys()
        again = words & self.old.keys()
        self.terminal.update((w, self.old[w]) for w in again)
        new = sorted(words - again)
        self.terminal.update(zip(new, self.walk(new), strict=True))
        self.long = [w for w in new if len(w) > LONG]

    def found(self, words: list[str]) -> list[tuple[int, float]]:
        """(pieces, score) of each of ``words``, all of which were inserted by the last call."""
        known, terminal = self.known, self.terminal
        return [known[w] if w in known else terminal[w] for w in words]


class Tries:
    """The trie of a call (``token``), built once a worker."""

    held: dict[str, ForwardTrie] = {}

    @classmethod
    def of(cls, token: str, pieces: dict[str, float], known: pa.Table | None = None) -> ForwardTrie:
        if token not in cls.held:
            rows = zip(*(known[c].to_pylist() for c in ("word", "n_tokens", "score")), strict=True) if known else ()
            cls.held = {token: ForwardTrie(pieces, known={w: (n, s) for w, n, s in rows})}
        return cls.held[token]


def most_frequent(words: DataFrame, most: int) -> tuple[DataFrame, int]:
    """(rows (word), how many) of the written ``words`` (word, n) of greatest n: at most ``most``, all of a class of counts or none of it."""
    words = words.select("word", F.floor(16 * F.log2("n")).alias("level"))
    sizes = {r.level: r["count"] for r in words.groupBy("level").count().collect()}  # 16 classes a doubling
    least, rows = max(sizes, default=0) + 1, 0
    for level in sorted(sizes, reverse=True):
        if rows + sizes[level] > most:
            break
        least, rows = level, rows + sizes[level]
    return words.where(F.col("level") >= least).select("word"), rows


def terminals(words: DataFrame, n_words: int, pieces: Broadcast) -> DataFrame:
    """Rows (word, n_tokens long, score double) of ``words`` (word): ranges of the sorted words, each one walk of the trie."""

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ForwardTrie(pieces.value)
        for batch in batches:
            ends = list(trie.walk(batch.column("word").to_pylist()))
            columns = [batch.column("word"), pa.array([n for n, _ in ends], pa.int64()), pa.array([s for _, s in ends], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "n_tokens", "score"])
        free_memory()

    ranges = words.repartitionByRange(1 + n_words // WALKED, "word").sortWithinPartitions("word")
    return ranges.mapInArrow(walked, "word string, n_tokens long, score double")


def token_counts(docs: DataFrame, path: str, frequent: int = FREQUENT, repeats: int = REPEATS) -> DataFrame:
    """Rows (doc_id long, n_words long, n_tokens long, score double): pre-tokens, tokens and log-probability of each text.

    The pieces of the tokenizer at ``path`` have their probabilities in all of ``docs``. Up to ``frequent`` pre-tokens
    that ``repeats`` proposes are scored once for the corpus; neither number changes a result.

    Null, empty and blank texts have none and score 0. Rows that share a doc_id are counted each on its own; pre-tokens
    of any length are walked whole; other columns are ignored; an empty table gives an empty table.
    """

    counts = materialize(corpus_counts(docs, path, repeats), "token-corpus")
    given = {r.piece: r.n for r in counts.where("piece IS NOT NULL").collect()}  # one number a piece of the file
    context, token = docs.sparkSession.sparkContext, uuid.uuid4().hex
    shared = context.broadcast(piece_scores(path, given))
    known = context.broadcast(terminals(*most_frequent(counts.where("word IS NOT NULL"), frequent), shared).toArrow())  # ``frequent`` rows of LONG characters

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        trie = Tries.of(token, shared.value, known.value)
        n_words, n_tokens, scores = [], [], []

        def count(texts: list[list[bytes]]) -> None:
            words = [x.decode() for text in texts for x in text]
            trie.insert(set(words))
            found = trie.found(words)
            at = 0
            for text in texts:
                own = found[at : at + len(text)]
                at += len(text)
                n_words.append(len(own))
                n_tokens.append(sum(c for c, _ in own))
                scores.append(sum(s for _, s in own))

        part, size = [], 0
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            part.append((text or b"").split())
            size += len(part[-1])
            if size > 1_000_000:
                count(part)
                part, size = [], 0
        count(part)
        columns = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(scores, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_tokens", "score"])

    view = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(view, one, "doc_id long, n_words long, n_tokens long, score double")
