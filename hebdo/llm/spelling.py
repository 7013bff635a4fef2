"""Spelling variants: words one inserted, deleted or replaced code point apart.

Every word is cut into windows of two code points, once as the longer word of
a pair and once as the shorter one. Words that agree outside a window meet in a group;
a group's words, as a matrix of padded code points, are compared in one dense
tile. Two words are near when their common prefix and suffix together reach
the longer length less one. A pair may agree around several windows and counts
in the one that holds the end of its common prefix.

A window of two letters bounds a group by the square of the alphabet. Words of
more than ``2 * windows`` code points have wider windows; their groups are cut
into blocks, and pairs of blocks are dealt over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import ascii_lower, stash, text_or_empty

RUN = "[A-Za-zÀ-ÿ]+"
ROW = "tile long, longer int, lo int, hi int, own int, other int, word string, n long"
FOUND = "word string, n_near long, best_n long, best string"


@dataclass(frozen=True)
class SpellingParams:
    shortest: int = 5        # code points of a word
    fewest: int = 3          # occurrences of a word
    ratio: int = 2           # a form is at least this many times as frequent
    deletion: int = 97       # runs whose checksum this divides lose a code point
    windows: int = 32        # most windows of a word
    block: int = 1024        # words of one side of a block pair
    batch: int = 1 << 16     # rows compared at a time


def word_counts(docs: DataFrame, params: SpellingParams = SpellingParams(), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(word, n). A null text has no words, a null id counts as an empty one."""
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(ascii_lower(text_or_empty(text_col)), F.lit(RUN), F.lit(0))).alias("run"))
    size = F.length("run")
    check = F.crc32(F.concat_ws(":", "doc", "run").cast("binary"))
    at = F.pmod(check, size).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, size))
    word = F.when(F.pmod(check, F.lit(params.deletion)) == 0, cut).otherwise(F.col("run"))
    return (runs.filter(size >= params.shortest).select(word.alias("word"))
            .filter(F.length("word") >= params.shortest)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= params.fewest))


def _window(k: Column, longer: Column, count: Column, word: Column, size: Column) -> Column:
    """Window ``k`` of a word as one of a pair whose longer word has ``longer`` code points."""
    lo = F.floor(k * longer / count).cast("int")
    hi = F.floor((k + 1) * longer / count).cast("int")
    return F.struct(
        F.xxhash64(longer, k, word.substr(F.lit(1), lo), word.substr(size - (longer - hi) + 1, longer)).alias("tile"),
        longer.alias("longer"), lo.alias("lo"), hi.alias("hi"))


def window_rows(words: DataFrame, params: SpellingParams = SpellingParams()) -> DataFrame:
    """words(word, n) -> one row per word, pair class and window, with its block pairs."""
    size = F.length("word")
    classes = words.select("word", "n", size.alias("size"), F.explode(F.array(size, size + 1)).alias("class"))
    count = F.least(F.ceil(F.col("class") / 2).cast("int"), F.lit(params.windows))
    rows = classes.select(
        "word", "n", F.explode(F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda k: _window(k, F.col("class"), count, F.col("word"), F.col("size")))).alias("w")).select(
        "w.*", "word", "n")
    small = rows.filter(F.col("longer") <= 2 * params.windows)
    small = small.withColumns({"own": F.lit(0), "other": F.lit(0)})
    # wide windows: the size of a group has no bound, so a large one becomes block pairs
    wide = rows.filter(F.col("longer") > 2 * params.windows)
    large = (wide.groupBy("tile").agg(F.ceil(F.count("*") / params.block).cast("int").alias("blocks"))
             .filter("blocks > 1"))
    blocks = F.coalesce("blocks", F.lit(1))
    wide = (wide.join(large, "tile", "left")
            .withColumn("own", F.pmod(F.xxhash64("word"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))))
    pair = F.xxhash64("tile", F.least("own", "other"), F.greatest("own", "other"))
    wide = wide.withColumn("tile", F.when(blocks > 1, pair).otherwise(F.col("tile")))
    columns = [f.split()[0] for f in ROW.split(", ")]
    return small.select(*columns).unionByName(wide.select(*columns))


def _matrix(codes: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, right: bool) -> np.ndarray:
    """Code points of words, padded with zeros on the right, or on the left if ``right``."""
    place = np.arange(width)
    at = place - (width - size)[:, None] if right else np.broadcast_to(place, (len(size), width))
    inside = (at >= 0) & (at < size[:, None])
    return np.where(inside, codes[np.where(inside, start[:, None] + at, 0)], 0)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of every row of ``a`` with every row of ``b``:
    (groups, rows, width) twice -> (groups, rows, rows)."""
    alive = np.ones((a.shape[0], a.shape[1], b.shape[1]), dtype=bool)
    total = np.zeros(alive.shape, dtype=np.int32)
    for c in range(a.shape[2]):
        alive &= a[:, :, None, c] == b[:, None, :, c]
        if not alive.any():
            break
        total += alive
    return total


def near_tile(prefix: np.ndarray, suffix: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """One edit apart: prefix and suffix together reach the longer length less one."""
    longer = np.maximum(size_a[..., :, None], size_b[..., None, :])
    shorter = np.minimum(size_a[..., :, None], size_b[..., None, :])
    return (longer - shorter <= 1) & (prefix + suffix >= longer - 1)


def compare_groups(codes: np.ndarray, start: np.ndarray, size: np.ndarray, first: np.ndarray, longer: np.ndarray,
                   lo: np.ndarray, hi: np.ndarray, own: np.ndarray, other: np.ndarray,
                   cells: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Rows of groups ``first[i]:first[i + 1]``, each ordered by preference -> how many
    near words a row has in its group's window, and the first of them (-1: none).
    Groups of one size and length are stacked; a stack has about ``cells`` pairs."""
    n_near = np.zeros(len(size), dtype=np.int64)
    best = np.full(len(size), -1, dtype=np.int64)
    count = np.diff(first)
    order = np.lexsort((count, longer[first[:-1]])) if len(count) else np.zeros(0, np.int64)
    order = order[count[order] > 1]
    keys = np.stack([longer[first[order]], count[order]]) if len(order) else np.zeros((2, 0))
    cuts = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
    for run in np.split(order, cuts) if len(order) else []:
        m, s = int(longer[first[run[0]]]), int(count[run[0]])
        rows_at_once = max(1, min(s, cells // (s * max(1, m // 64))))
        step = max(1, cells // (s * s * max(1, m // 64)))
        for k in range(0, len(run), step):
            rows = first[run[k:k + step], None] + np.arange(s)
            flat = rows.ravel()
            shape = (len(rows), s, m)
            left = _matrix(codes, start[flat], size[flat], m, False).reshape(shape)
            right = _matrix(codes, start[flat], size[flat], m, True).reshape(shape)[:, :, ::-1]
            for r in range(0, s, rows_at_once):
                part = slice(r, r + rows_at_once)
                prefix = _common(left[:, part], left)
                suffix = _common(right[:, part], right)
                a, b = rows[:, part], rows
                near = near_tile(prefix, suffix, size[a], size[b])
                # of the pair class, of this window, of this pair of blocks, and not with itself
                near &= np.maximum(size[a][:, :, None], size[b][:, None, :]) == m
                near &= (prefix >= lo[a][:, :, None]) & (prefix < hi[a][:, :, None])
                near &= (other[a][:, :, None] == own[b][:, None, :]) & (own[a][:, :, None] == other[b][:, None, :])
                near &= a[:, :, None] != b[:, None, :]
                n_near[a] = near.sum(axis=2)
                best[a] = np.where(near.any(axis=2), np.take_along_axis(
                    np.broadcast_to(b[:, None, :], near.shape), near.argmax(axis=2)[:, :, None], axis=2)[:, :, 0], -1)
    return n_near, best


def _compare(tab: pa.Table, first: np.ndarray) -> pa.RecordBatch:
    word = tab.column("word").combine_chunks()
    size = pc.utf8_length(word).to_numpy().astype(np.int64)
    codes = np.frombuffer("".join(word.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
    start = np.cumsum(size) - size
    col = {k: tab.column(k).to_numpy().astype(np.int64) for k in ("longer", "lo", "hi", "own", "other", "n")}
    n_near, best = compare_groups(codes, start, size, first, *(col[k] for k in ("longer", "lo", "hi", "own", "other")))
    hit = np.flatnonzero(n_near)
    return pa.RecordBatch.from_arrays(
        [word.take(pa.array(hit)), pa.array(n_near[hit]), pa.array(col["n"][best[hit]]), word.take(pa.array(best[hit]))],
        names=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, params: SpellingParams = SpellingParams()) -> DataFrame:
    """words(word, n), distinct -> (word, n_near, best_n, best) of words with a near word;
    best is the near word of largest n, ties by code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def ready(last: bool) -> pa.RecordBatch | None:
            nonlocal held, waiting
            if not held:
                return None
            tab = pa.Table.from_batches(held)
            tile = tab.column("tile").to_numpy()
            first = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
            end = len(tile) if last else int(first[-1])   # the last group may go on
            held, waiting = tab.slice(end).to_batches(), len(tile) - end
            first = np.append(first[first < end], end)
            return _compare(tab.slice(0, end), first) if end else None

        for batch in batches:
            held.append(batch)
            waiting += batch.num_rows
            if waiting >= params.batch:
                out = ready(False)
                if out is not None:
                    yield out
        out = ready(True)
        if out is not None:
            yield out

    rows = (window_rows(words, params).repartition("tile")
            .sortWithinPartitions("tile", F.desc("n"), "word"))
    found = rows.mapInArrow(run, FOUND)
    top = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("t")).select(
        "word", "n_near", (-F.col("t.m")).alias("best_n"), F.col("t.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """forms(word, form): follow forms to the last -> (word, root).

    Pointer doubling: each round joins the pointers with themselves, so the rounds
    grow with the logarithm of the longest chain. A form is more frequent than its
    word, so there are no circles."""
    cur = stash(forms.select("word", F.col("form").alias("root")))
    while True:
        step = cur.select(F.col("word").alias("root"), F.col("root").alias("_on"))
        cur = stash(cur.select("word", "root").join(step, "root", "left").select(
            "word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("moved")))
        if cur.filter("moved").isEmpty():
            return cur.select("word", "root")


def spelling_variants(docs: DataFrame, params: SpellingParams = SpellingParams(), id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    A null or empty text has no words, an empty table no rows. Repeated rows count
    as often as they stand; of near words with the same n the first by code points
    is the form. Other columns, whatever their names, are ignored.
    """
    words = stash(word_counts(docs, params, id_col, text_col))
    near = near_words(words, params).withColumnRenamed("word", "_word")
    is_form = F.col("best_n") >= params.ratio * F.col("n")
    judged = stash(words.join(near, F.col("word") == F.col("_word"), "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best_n")).cast("long").alias("form_n")))
    ends = roots(judged.filter("form is not null"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
