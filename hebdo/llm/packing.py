"""Bounded-space online packing of token sequences.

Each partition keeps a fixed number of open windows. A document's whole
windows are emitted at once; its rest goes to the open window that it fills
best. When none has room, the fullest is topped up with the first ids of the
rest and emitted. What is open at the end goes, with its ids, to a merge of
the leftovers of a fixed number of partitions, which lays them end to end; the
very last ids of a merge are cut at powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import record_batches, stash
from hebdo.llm.tokens import Texts, mix

PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
         "sequence_id long, offset long")
_FIELDS = [f.split()[0] for f in PIECE.split(", ")]
_encoders: dict[str, "Encoder"] = {}


@dataclass(frozen=True)
class PackParams:
    tokenizer: str                # path of a tokenizers file
    length: int = 2048
    windows: int = 8              # open windows per partition
    merge: int = 32               # partitions whose leftovers meet
    end_id: int = 1
    remember: int = 16 << 20      # bytes of encoded words that a worker remembers


_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[48:58] = _ALNUM[97:123] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True
_MARK[ord("'")] = False


class Encoder:
    """Token ids of texts, for tokenizers that lower-case, drop white space and split
    letters, digits and other marks before they merge. Words, parted from marks that
    follow an ASCII letter or digit (but not from apostrophes), are encoded once and
    remembered: neither normaliser nor splitter looks across those borders.

    The memory is a table of word hashes and id runs in arrays, about 30 bytes a word; beyond
    ``limit`` bytes it starts again with the words at hand."""

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.limit = limit
        self.key = np.zeros(0, dtype=np.uint64)        # hashes of known words, ascending
        self.size = np.zeros(0, dtype=np.uint32)       # their lengths in bytes, to tell hashes further apart
        self.run = np.zeros((0, 2), dtype=np.int64)    # where their ids begin, and how many they are
        self.ids = np.zeros(0, dtype="<u4")

    def _encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Encode many words as one text; the offsets say which ids are whose: (ids, how many each)."""
        plain = [w.decode() for w in words]
        coded = self.tokenizer.encode(" ".join(plain), add_special_tokens=False)
        ends = np.cumsum([len(w) + 1 for w in plain])
        at = np.searchsorted(np.array([a for a, _ in coded.offsets], dtype=np.int64), ends)
        return np.array(coded.ids, dtype="<u4"), np.diff(at, prepend=0)

    def _learn(self, key: np.ndarray, size: np.ndarray, words: list[bytes]) -> None:
        parts = [self._encoded(words[lo:lo + 2048]) for lo in range(0, len(words), 2048)]
        n = np.concatenate([c for _, c in parts])
        run = np.stack([len(self.ids) + np.cumsum(n) - n, n], axis=1)
        self.ids = np.concatenate([self.ids, *(ids for ids, _ in parts)])
        key, size, run = (np.concatenate(x) for x in ((self.key, key), (self.size, size), (self.run, run)))
        order = np.argsort(key, kind="stable")
        self.key, self.size, self.run = key[order], size[order], run[order]

    def _find(self, key: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words in the table, and which of them are there."""
        at = np.searchsorted(self.key, key)
        near = np.minimum(at, max(len(self.key) - 1, 0))
        known = (self.key[near] == key) & (self.size[near] == size) if len(self.key) else np.zeros(len(key), dtype=bool)
        return near, known

    def encode(self, texts: Texts) -> list[np.ndarray]:
        data = texts.data
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = _ALNUM[data[:-1]] & _MARK[data[1:]]
        starts, ends, first = texts.words(cuts=cut)
        size = (ends - starts).astype(np.uint32)
        key, one, word = np.unique(texts.hashes(starts, ends) ^ mix(size.astype(np.uint64)),
                                   return_index=True, return_inverse=True)
        own = size[one]
        if 20 * len(self.key) + 4 * len(self.ids) > self.limit:
            at, known = self._find(key, own)           # the words at hand stay
            at = at[known]
            run = self.run[at]
            self.key, self.size = self.key[at], self.size[at]
            self.ids, self.run = _taken(self.ids, run), np.stack([np.cumsum(run[:, 1]) - run[:, 1], run[:, 1]], axis=1)
        _, known = self._find(key, own)
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            self._learn(key[new], own[new], [raw[a:b] for a, b in zip(starts[one[new]], ends[one[new]])])
        run = self.run[self._find(key, own)[0]][word]
        ids = _taken(self.ids, run)
        upto = np.concatenate([[0], np.cumsum(run[:, 1])])[first]
        return [ids[a:b] for a, b in zip(upto[:-1], upto[1:])]


def _taken(ids: np.ndarray, run: np.ndarray) -> np.ndarray:
    """The runs (begin, length) of ``ids``, one after the other."""
    n = run[:, 1]
    before = np.cumsum(n) - n
    return ids[np.repeat(run[:, 0] - before, n) + np.arange(n.sum())]


def encoder(params: PackParams) -> Encoder:
    if params.tokenizer not in _encoders:
        _encoders[params.tokenizer] = Encoder(params.tokenizer, params.remember)
    return _encoders[params.tokenizer]


class Packer:
    """The open windows of one partition. A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, length: int, windows: int):
        self.length, self.windows = length, windows
        self.open: list[list] = []        # [free, pieces]
        self.done: list[list] = []

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        at, total, size = 0, len(ids), self.length
        while total - at >= size:
            self.done.append([(doc, at, ids[at:at + size], total)])
            at += size
        while at < total:
            need = total - at
            fit = [w for w in self.open if w[0] >= need]
            if fit:
                w = min(fit, key=lambda w: w[0])
            elif len(self.open) < self.windows:
                w = [size, []]
                self.open.append(w)
            else:
                w = min(self.open, key=lambda w: w[0])
                need = w[0]
            w[1].append((doc, at, ids[at:at + need], total))
            w[0] -= need
            at += need
            if w[0] == 0:
                self.open.remove(w)
                self.done.append(w[1])


def _rows(sequences: list[list], first: int) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in _FIELDS}
    for i, pieces in enumerate(sequences):
        offset = 0
        for doc, start, ids, total in pieces:
            for k, v in zip(_FIELDS, (doc, start, len(ids), zlib.crc32(ids.tobytes()), total, first + i, offset)):
                out[k].append(v)
            offset += len(ids)
    return out


def lay_out(pieces: list[tuple], length: int) -> list[list]:
    """Pieces end to end in sequences of ``length``; the last ids in powers of two."""
    total = sum(len(p[2]) for p in pieces)
    sizes = [length] * (total // length)
    rest = total % length
    sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    out: list[list] = []
    queue = list(reversed(pieces))
    for size in sizes:
        own = []
        while size:
            doc, start, ids, tokens = queue.pop()
            if len(ids) > size:
                queue.append((doc, start + size, ids[size:], tokens))
                ids = ids[:size]
            own.append((doc, start, ids, tokens))
            size -= len(ids)
        out.append(own)
    return out


def pack(docs: DataFrame, params: PackParams, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A null or empty text is the end id alone. Null and repeated ids are packed
    row by row like any other; other columns are ignored.
    """
    schema = PIECE + ", part int, slot int, ids binary"

    def run(batches):
        part = TaskContext.get().partitionId()
        enc, packer, made = encoder(params), Packer(params.length, params.windows), 0
        end = np.array([params.end_id], dtype="<u4")
        for rb in record_batches(batches, "text"):
            for doc, ids in zip(rb.column("doc_id").to_pylist(), enc.encode(Texts(rb.column("text"), lower=True))):
                packer.add(doc, np.concatenate([ids, end]))
            rows = _rows(packer.done, (part << 32) + made)
            made += len(packer.done)
            packer.done = []
            n = len(rows["start"])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(rows[k], pa.int64()) for k in _FIELDS), pa.nulls(n, pa.int32()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=[*_FIELDS, "part", "slot", "ids"])
        left = [(i, p) for i, w in enumerate(packer.open) for p in w[1]]
        if left:
            col = [[p[0] for _, p in left], [p[1] for _, p in left], [len(p[2]) for _, p in left],
                   [0] * len(left), [p[3] for _, p in left]]
            none = pa.nulls(len(left), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in col), none, none, pa.array([part] * len(left), pa.int32()),
                 pa.array([i for i, _ in left], pa.int32()), pa.array([p[2].tobytes() for _, p in left])],
                names=[*_FIELDS, "part", "slot", "ids"])

    packed = stash(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                   .mapInArrow(run, schema))

    def merge(tab: pa.Table) -> pa.Table:
        rows = sorted(tab.to_pylist(), key=lambda r: (r["part"], r["slot"], r["doc_id"] is None, r["doc_id"] or 0, r["start"]))
        pieces = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], dtype="<u4"), r["doc_tokens"]) for r in rows]
        first = (1 << 62) + (rows[0]["part"] // params.merge << 32)
        out = _rows(lay_out(pieces, params.length), first)
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    left = packed.filter("sequence_id is null").withColumn("lot", F.expr(f"part div {params.merge}"))
    merged = left.groupBy("lot").applyInArrow(merge, PIECE)
    return packed.filter("sequence_id is not null").select(*_FIELDS).unionByName(merged)
