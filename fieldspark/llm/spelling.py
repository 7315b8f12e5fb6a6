"""Spelling variants: words of one single edit, found by dense prefix and suffix tiles.

A single edit (one code point inserted, deleted or replaced) leaves a common prefix and a common suffix that together
reach the longer length minus one. One of the two is then at least half of that, so the pair shares a bucket: the longer
length and the first, or the last, ``half`` code points. Each word is in four buckets (as longer or equal word and as
shorter word, by prefix and by suffix). A bucket's words are rows of a padded matrix of code points, cut into blocks;
two blocks are a tile, compared as a whole: lengths of common prefixes and suffixes of all its pairs.

Tiles return no pairs but, for each word, how many near words it met and the best of them; these add up by word.
Buckets of more than ``BLOCK`` words are dealt out as tiles to many tasks, so no bucket is one task's work.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import materialize

RUN = re.compile("[a-zA-ZÀ-ÿ]+")
#: Words of a block, words that a task counts before it hands them on, and code points of a matrix.
BLOCK, HELD, CELLS = 2_000, 200_000, 2_000_000
#: Words of small tiles that are compared together.
TOGETHER = 64
#: Words up to which the table of words is broadcast.
FEW_WORDS = 100_000


def runs_of(text: bytes) -> list[str]:
    """Maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z lower-cased."""
    return RUN.findall(text.lower().decode())


def misspelt(doc_id: int | None, run: str, every: int) -> str:
    """The run without one code point if ``every`` divides the CRC-32 of ``<doc_id>:<run>``; a null id is written as nothing."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    at = h % len(run)
    return run if not every or h % every else run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, min_chars: int = 6, min_count: int = 5, every: int = 0) -> DataFrame:
    """Rows (word, n) of the words of all texts with at least ``min_chars`` code points and ``min_count`` occurrences.

    ``every`` plants misspellings (see ``misspelt``). Tasks count before anything shuffles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def give() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                if text.is_valid:
                    for word, n in Counter(runs_of(text.as_py())).items():
                        word = misspelt(ids[i], word, every)
                        if len(word) >= min_chars:
                            held[word] += n
                if len(held) > HELD:
                    yield give()
        yield give()
        pa.default_memory_pool().release_unused()

    view = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return view.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def buckets(words: DataFrame) -> DataFrame:
    """Rows (word, n, bucket): each word in the four buckets where all its near words are."""
    length, keys = F.length("word"), []
    for longer in (length, length + 1):  # as the longer or an equal word, as the shorter one
        half = F.floor(longer / 2).cast("int")  # of the longer length minus one, rounded up
        first = F.substring(F.col("word"), F.lit(1), half)
        last = F.substring(F.col("word"), F.greatest(length - half + 1, F.lit(1)), half)
        keys += [F.struct(longer.alias("longer"), F.lit(side).alias("side"), key.alias("key")) for side, key in (("p", first), ("s", last))]
    return words.select("word", "n", F.explode(F.array(*keys)).alias("bucket"))


def tiles(rows: DataFrame, block: int) -> DataFrame:
    """Rows (word, n, bucket, part, tile): buckets above ``block`` words are cut into parts, and each pair of parts is a tile."""
    sizes = rows.groupBy("bucket").count()
    large = materialize(sizes.where(F.col("count") > block), "spelling-large")
    parts = F.ceil(F.col("count") / block).cast("int")
    mine = F.pmod(F.xxhash64("word"), parts).cast("int")
    cells = F.transform(F.sequence(F.lit(0), parts - 1), lambda j: F.struct(F.least(j, mine).alias("i"), F.greatest(j, mine).alias("j")))
    one = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    few = large.count()
    joined = rows.join(F.broadcast(large) if few <= FEW_WORDS else large, "bucket", "left")
    part = F.when(F.col("count").isNull(), 0).otherwise(mine)
    return joined.select("word", "n", "bucket", part.alias("part"), F.explode(F.when(F.col("count").isNull(), one).otherwise(cells)).alias("tile"))


def padded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points by row, padded with zeros behind; lengths)."""
    lengths = np.fromiter(map(len, words), np.int32, len(words))
    out = np.zeros((len(words), int(lengths.max(initial=0))), np.uint32)
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = codes
    return (out.astype(np.uint16) if out.max(initial=0) < 1 << 16 else out), lengths


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of the rows of ``a`` with those of ``b``; rows are padded with unequal values."""
    going = np.ones((len(a), len(b)), bool)
    out = np.zeros((len(a), len(b)), np.uint8 if a.shape[1] < 256 else np.int32)
    for k in range(min(a.shape[1], b.shape[1])):
        going &= a[:, None, k] == b[None, :, k]
        if not going.any():
            break
        out += going
    return out


def sides(codes: np.ndarray, lengths: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows from the front, rows from the back), padded with ``pad`` behind the word."""
    wide = np.arange(codes.shape[1])
    inside = wide < lengths[:, None]
    back = np.take_along_axis(codes, np.where(inside, lengths[:, None] - 1 - wide, 0), 1)
    kind = np.int32 if codes.dtype == np.uint16 else np.int64
    return np.where(inside, codes, pad).astype(kind), np.where(inside, back, pad).astype(kind)


def near_in_tile(words: list[str], tile: np.ndarray, left: np.ndarray, right: np.ndarray, longer: int, by_suffix: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (a, b) of words one edit apart, a of ``left``, b of ``right`` and both of one ``tile``, each pair once.

    ``longer`` is the bucket's greater length. A pair that also shares a prefix bucket is left to that one.
    """
    half, step = longer // 2, max(1, min(1_400, CELLS // (longer + 1)))

    def half_matrices(at: np.ndarray, pad: int) -> tuple[np.ndarray, ...]:
        codes, lengths = padded([words[k] for k in at])
        return (at, lengths, *sides(codes, lengths, pad))

    for r in range(0, len(right), step):
        b_at, b_len, b_front, b_back = half_matrices(right[r : r + step], -2)
        for s in range(0, len(left), step):
            a_at, a_len, a_front, a_back = half_matrices(left[s : s + step], -1)
            prefix, suffix = common(a_front, b_front), common(a_back, b_back)
            one, other = a_len[:, None], b_len[None, :]
            ok = (np.maximum(one, other) == longer) & (np.abs(one - other) <= 1) & (tile[a_at][:, None] == tile[b_at][None, :])
            ok &= prefix.astype(np.int32) + suffix >= longer - 1
            ok &= (prefix < half) if by_suffix else (prefix >= half)
            ok &= ~((one == other) & (prefix == one))  # the word itself
            if left is right:
                ok &= a_at[:, None] < b_at[None, :]
            a, b = np.nonzero(ok)
            if len(a):
                yield a_at[a], b_at[b]


def tile_results(rows: DataFrame) -> DataFrame:
    """Rows (word, n_near, best_n, best_word) of each tile: what a word has met there."""
    names = ["word", "n_near", "best_n", "best_word"]
    schema = "word string, n_near long, best_n long, best_word string"

    def solve(words: list[str], ns: np.ndarray, part: np.ndarray, tile: np.ndarray, longer: int, side: str, i: int, j: int) -> pa.RecordBatch:
        rank = np.empty(len(words), np.int64)
        order = np.array(sorted(range(len(words)), key=lambda k: (-ns[k], words[k])))  # the best word first
        rank[order] = np.arange(len(words))
        near, lowest = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
        left = np.flatnonzero(part == i)
        right = left if i == j else np.flatnonzero(part == j)
        for a, b in near_in_tile(words, tile, left, right, longer, side == "s"):
            for x, y in ((a, b), (b, a)):
                near += np.bincount(x, minlength=len(words))
                np.minimum.at(lowest, x, rank[y])
        met = np.flatnonzero(near)
        best = order[lowest[met]]
        return pa.RecordBatch.from_arrays([pa.array([words[k] for k in met], pa.string()), pa.array(near[met]), pa.array(ns[best]), pa.array([words[k] for k in best], pa.string())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by tile. Small tiles of one side and length are compared together, others one by one."""
        held: list[tuple[list, list[tuple[str, int, int]]]] = []
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            full = [x for x in held if len(x[1]) > 1]
            held.clear()
            if full:
                longer, side, _, i, j = full[0][0]
                rows = [r for _, own in full for r in own]
                tile = np.repeat(np.arange(len(full)), [len(own) for _, own in full])
                out = solve([r[0] for r in rows], np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows]), tile, longer, side, i, j)
                if out.num_rows:
                    yield out

        for batch in batches:
            for word, n, p, *own in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "part", "longer", "side", "key", "i", "j")), strict=True):
                if not held or held[-1][0] != own:
                    if held and (size > TOGETHER or held[-1][0][:2] != own[:2] or own[3:] != [0, 0] or held[-1][0][3:] != [0, 0]):
                        yield from close()
                        size = 0
                    elif held and len(held[-1][1]) == 1:
                        held.pop()
                        size -= 1
                    held.append((own, []))
                held[-1][1].append((word, n, p))
                size += 1
        yield from close()

    keys = ["longer", "side", "key", "i", "j"]
    flat = rows.select("word", "n", "part", "bucket.longer", "bucket.side", "bucket.key", "tile.i", "tile.j")
    return flat.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def near_words(words: DataFrame, block: int | None = None) -> DataFrame:
    """Rows (word, n_near, best_n, best_word) of the words that have near ones: their number and the most frequent (ties: the least)."""
    met = tile_results(tiles(buckets(words), block or BLOCK))
    top = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("k"), "best_word")).alias("best"))
    return top.select("word", "n_near", (-F.col("best.k")).alias("best_n"), F.col("best.best_word").alias("best_word"))


def roots(forms: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Rows (word, root): ``form`` followed to the last word by doubling steps; counts rise along it, so it ends."""
    state = materialize(forms.select("word", F.coalesce("form", "word").alias("root")), "spelling-roots")
    for _ in range(max_rounds):
        ahead = state.where("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = ahead.join(state.select("root").distinct(), "root")
        size = step.count()
        if not size:
            return state
        joined = state.join(F.broadcast(step) if size <= FEW_WORDS else step, "root", "left")
        state = materialize(joined.select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    raise RuntimeError(f"roots did not settle in {max_rounds} rounds")


def spelling_variants(docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5, every: int = 0, block: int | None = None) -> DataFrame:
    """Rows (word, n, n_near, form, form_n, root) of all words of ``docs`` with enough code points and occurrences.

    A word's near words differ from it by exactly one inserted, deleted or replaced code point. Its form is the near
    word of largest n (ties: smallest in code-point order) if that n is at least ``ratio`` times its own, else null; its
    root is where forms lead. Words are runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased. Null and empty texts
    have no words; repeated rows count again; a null doc_id only changes where ``every`` plants a misspelling. An empty
    table gives an empty table; other columns are ignored.
    """
    words = materialize(word_counts(docs, min_chars, min_count, every), "spelling-words")
    found = words.join(near_words(words, block), "word", "left")
    good = F.col("best_n") >= ratio * F.col("n")
    found = materialize(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best_word")).alias("form"), F.when(good, F.col("best_n")).alias("form_n")), "spelling-forms")
    return found.join(roots(found), "word")
