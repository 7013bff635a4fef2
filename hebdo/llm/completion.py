"""Best-fit packing of whole documents: bin completion over the histogram of lengths.

Which document goes where depends on its length alone, so the plan is made on the
counts of the at most ``length`` distinct lengths, whatever the number of
documents: fillings around the largest length left, each taken as often as the
counts allow, searched by branch and bound from a best-fit-decreasing incumbent.
Spark then deals the documents of a length to the places of the plan by rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hebdo.llm.common import record_batches, stash
from hebdo.llm.tokens import Texts

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
CUT = PIECE + ", part int, nth long"
PLACED = PIECE + ", sequence_id long, offset long"
_FIELDS = [f.split()[0] for f in PIECE.split(", ")]


@dataclass(frozen=True)
class CompletionParams:
    tokenizer: str               # path of a byte-level tokenizers file
    ranks: str = ""              # the same vocabulary as tiktoken ranks (optional, faster)
    pattern: str = ""            # and its splitting pattern
    length: int = 1024
    end_id: int = 2
    branches: int = 6            # fillings tried at a node, best fit first
    nodes: int = 4000            # nodes searched beyond the first descent


# ------------------------------------------------------------------ the plan

Filling = tuple[tuple[int, int], ...]   # ((length, how often), ...), longest first


def lower_bound(counts: dict[int, int], size: int) -> int:
    """Martello and Toth's bound: no packing has fewer bins."""
    if not counts:
        return 0
    s = np.array(sorted(counts), dtype=np.int64)
    n = np.array([counts[int(x)] for x in s], dtype=object)
    mass = np.concatenate([[0], np.cumsum(n * s)])
    many = np.concatenate([[0], np.cumsum(n)])
    best = -(-int(mass[-1]) // size)
    half = int(np.searchsorted(s, size // 2, side="right"))
    for i in range(half + 1):
        low = int(s[i]) if i < half else size // 2 + 1
        big = max(half, int(np.searchsorted(s, size - low, side="right")))
        alone = int(many[-1] - many[big])
        pairs = int(many[big] - many[half])
        room = pairs * size - int(mass[big] - mass[half])
        rest = int(mass[half] - mass[i]) - room
        best = max(best, alone + pairs + max(0, -(-rest // size)))
    return best


def best_fit_decreasing(counts: dict[int, int], size: int) -> list[tuple[Filling, int]]:
    """Longest first, each into the fullest bin with room; equal bins are one class."""
    classes: dict[tuple[int, Filling], int] = {}     # (room, filling) -> bins
    for s in sorted(counts, reverse=True):
        left = counts[s]
        while left:
            fits = [k for k in classes if k[0] >= s]
            if fits:
                room, filling = key = min(fits)
                bins = classes.pop(key)
            else:
                room, filling, bins = size, (), -(-left // (size // s))
            per = room // s
            full, rest = min(bins, left // per), 0
            if full:
                key = (room - per * s, (*filling, (s, per)))
                classes[key] = classes.get(key, 0) + full
                left -= full * per
            if full < bins and left and left < per:
                key = (room - left * s, (*filling, (s, left)))
                classes[key] = classes.get(key, 0) + 1
                left, rest = 0, 1
            if filling and bins - full - rest:
                key = (room, filling)
                classes[key] = classes.get(key, 0) + bins - full - rest
    return [(filling, bins) for (_, filling), bins in classes.items()]


def fillings(counts: dict[int, int], gap: int, limit: int) -> list[Filling]:
    """Up to ``limit`` undominated fillings of ``gap``, least waste first, longest items first."""
    sizes = sorted(s for s in counts if s <= gap and counts[s])
    if not sizes:
        return [()]
    reach = [1]                                       # bit t: the sizes so far can sum to t
    keep = (1 << gap + 1) - 1
    for s in sizes:
        bits, n, step = reach[-1], min(counts[s], gap // s), 1
        while n:
            take = min(step, n)
            bits |= bits << s * take & keep
            n, step = n - take, 2 * step
        reach.append(bits)
    out: list[Filling] = []

    def search(i: int, left: int, chosen: Filling) -> Iterator[Filling]:
        """Fillings of exactly ``left`` from the ``i`` smallest sizes."""
        if not left:
            yield chosen
            return
        while i and not reach[i - 1] >> left & 1 and sizes[i - 1] > left:
            i -= 1
        if not i or not reach[i] >> left & 1:
            return
        s = sizes[i - 1]
        for n in range(min(counts[s], left // s), -1, -1):
            if reach[i - 1] >> left - n * s & 1:
                yield from search(i - 1, left - n * s, (*chosen, (s, n)) if n else chosen)

    for waste in range(gap + 1):
        if reach[-1] >> gap - waste & 1:
            for tried, filling in enumerate(search(len(sizes), gap - waste, ())):
                if not dominated(filling, counts, sizes, waste):
                    out.append(filling)
                if len(out) >= limit:
                    return out
                if tried >= 4 * limit:
                    break
        if out and waste >= sizes[0]:                 # anything looser leaves room for an item
            break
    return out


def dominated(filling: Filling, counts: dict[int, int], sizes: list[int], waste: int) -> bool:
    """Whether another filling of the gap is at least as good: a free item fits the waste,
    or a longer free item can stand for one item or for two of the filling."""
    used = dict(filling)
    free = [s for s in sizes if counts[s] > used.get(s, 0)]
    if free and free[0] <= waste:
        return True
    have = np.array(free, dtype=np.int64)
    items = [s for s, n in filling for _ in range(min(n, 2))]
    sums = [(s, s) for s in items] + [(a + b, a + b - 1) for i, a in enumerate(items) for b in items[i + 1:]]
    for total, above in sums:
        k = int(np.searchsorted(have, above, side="right"))
        if k < len(have) and have[k] <= total + waste:
            return True
    return False


def complete_bins(counts: dict[int, int], params: CompletionParams) -> list[tuple[Filling, int]]:
    """Counts by length -> (filling, bins): all items, in as few bins as the search finds."""
    size = params.length
    counts = {int(s): int(n) for s, n in counts.items() if n}
    bound = lower_bound(counts, size)
    best = best_fit_decreasing(counts, size)
    best_bins = sum(n for _, n in best)
    total = sum(s * n for s, n in counts.items())
    if best_bins == bound:
        return best

    def options(left: dict[int, int]) -> Iterator[Filling]:
        s = max(left)
        rest = dict(left)
        rest[s] -= 1
        for filling in fillings(rest, size - s, params.branches):
            used = dict(filling)
            used[s] = used.get(s, 0) + 1
            yield tuple(sorted(used.items(), reverse=True))

    stack = [(counts, 0, 0, options(counts))]         # counts left, bins, waste, fillings to try
    chosen: list[tuple[Filling, int]] = []
    nodes, descended = 0, False
    while stack and best_bins > bound and (not descended or nodes < params.nodes):
        left, bins, waste, tries = stack[-1]
        filling = next(tries, None)
        if filling is None:
            stack.pop()
            if chosen:
                chosen.pop()
            continue
        nodes += descended
        many = min(left[s] // n for s, n in filling)
        after = dict(left)
        for s, n in filling:
            after[s] -= n * many
            if not after[s]:
                del after[s]
        bins_after = bins + many
        waste_after = waste + many * (size - sum(s * n for s, n in filling))
        if not after:
            if bins_after < best_bins:
                best, best_bins = [*chosen, (filling, many)], bins_after
            descended = True
            continue
        # the first descent goes to its end; after it, what cannot beat the best is cut
        if descended and (waste_after > (best_bins - 1) * size - total
                          or bins_after + lower_bound(after, size) >= best_bins):
            continue
        chosen.append((filling, many))
        stack.append((after, bins_after, waste_after, options(after)))
    return best


# ------------------------------------------------------------------ tokens

_encoders: dict[str, "ByteEncoder"] = {}


class ByteEncoder:
    """Ids of a byte-level tokenizers file. Texts of Latin letters and common punctuation,
    over which no version of Unicode differs, may go through the same vocabulary's ranks."""

    def __init__(self, params: CompletionParams):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(params.tokenizer)
        self.slow.encode_special_tokens = True
        self.fast = None
        if params.ranks:
            import base64

            import tiktoken

            with open(params.ranks, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=params.pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: Texts) -> Iterator[np.ndarray]:
        data = texts.data
        odd = data >= 0xC9                            # beyond U+023F
        odd[:-1] &= ~((data[:-1] == 0xE2) & (data[1:] < 0xB0))
        plain = texts.count(odd) == 0
        raw = data.tobytes()
        for i in range(texts.n):
            text = raw[texts.offsets[i]:texts.offsets[i + 1]].decode()
            ids = (self.fast.encode_ordinary(text) if self.fast and plain[i]
                   else self.slow.encode(text, add_special_tokens=False).ids)
            yield np.array(ids, dtype="<u4")


def encoder(params: CompletionParams) -> ByteEncoder:
    if params.tokenizer not in _encoders:
        _encoders[params.tokenizer] = ByteEncoder(params)
    return _encoders[params.tokenizer]


def pieces(docs: DataFrame, params: CompletionParams, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as pieces of at most ``length`` ids; only a first piece is shorter. ``nth``
    numbers the pieces of one length in the task ``part`` that cut them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size = TaskContext.get().partitionId(), params.length
        enc, seen = encoder(params), np.zeros(params.length + 1, dtype=np.int64)
        for rb in record_batches(batches, "text"):
            rows = []
            for doc, ids in zip(rb.column("doc_id").to_pylist(), enc.encode(Texts(rb.column("text")))):
                ids = np.append(ids, np.uint32(params.end_id)).astype("<u4")
                first = (len(ids) - 1) % size + 1
                for piece, end in enumerate(range(first, len(ids) + 1, size)):
                    start = end - size if piece else 0
                    n = end - start
                    rows.append((doc, piece, start, n, zlib.crc32(ids[start:end].tobytes()), part, seen[n]))
                    seen[n] += 1
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             names=[*_FIELDS, "part", "nth"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, CUT)


# ------------------------------------------------------------------ places

def places(plan: list[tuple[Filling, int]], size: int) -> dict[int, np.ndarray]:
    """The plan as, for each length, columns (first rank, uses per bin, first bin, first offset)."""
    out: dict[int, list] = {}
    used: dict[int, int] = {}
    first_bin = 0
    for filling, bins in plan:
        at = 0
        for s, n in filling:
            out.setdefault(s, []).append((used.get(s, 0), n, first_bin, at))
            used[s] = used.get(s, 0) + n * bins
            at += s * n
        first_bin += bins
    return {s: np.array(rows, dtype=np.int64).T for s, rows in out.items()}


def best_fit_pack(docs: DataFrame, params: CompletionParams, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    A null or empty text is the end id alone; null and repeated ids are packed row by
    row like any other, an empty table gives no rows. Which of several pieces of one
    length goes where follows from the order in which the tasks met them. Other
    columns, whatever their names, are ignored.
    """
    cut = stash(pieces(docs, params, id_col, text_col))
    per_task = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    ranked = cut.join(per_task.withColumn("before", before), ["part", "length"])
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = places(complete_bins(counts, params), params.length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            n, rank = (rb.column(k).to_numpy() for k in ("length", "rank"))
            sequence, offset = np.empty(len(n), dtype=np.int64), np.empty(len(n), dtype=np.int64)
            for s in np.unique(n):
                own = n == s
                first, uses, bins, at = plan[int(s)]
                k = np.searchsorted(first, rank[own], side="right") - 1
                inside = rank[own] - first[k]
                sequence[own] = bins[k] + inside // uses[k]
                offset[own] = at[k] + inside % uses[k] * s
            yield pa.RecordBatch.from_arrays([*(rb.column(k) for k in _FIELDS), pa.array(sequence), pa.array(offset)],
                                             names=[*_FIELDS, "sequence_id", "offset"])

    return ranked.select(*_FIELDS, (F.col("before") + F.col("nth")).alias("rank")).mapInArrow(run, PLACED)
