"""How the sources of a language differ: an audit by one-hot level products.

A level is a (group, count) pair; a term is a one-hot row with one level of each
group, zero counts included. The product of a block's indicator columns with
their transpose is the joint table of levels for every pair of groups at
once; it is exact in single precision, because a cell counts rows of a block. Each
joint table is priced by what two levels differ, and the blocks' sums are added.

Terms are dealt into blocks of similar total counts, so a block has few levels;
groups are dealt into blocks as well, so no task holds all sources.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hebdo.llm.common import record_batches, stash, text_or_empty
from hebdo.llm.tokens import Texts

COUNTED = "lang string, source string, term string, count long, docs long"
PRICED = "lang string, a int, b int, value long"

#: bytes that part terms: those of `[\x00-\x40\x5B-\x60\x7B-\x7F]`
_GAP = np.zeros(256, dtype=bool)
_GAP[:65] = _GAP[91:97] = _GAP[123:128] = True


@dataclass(frozen=True)
class DivergenceParams:
    min_docs: int = 10        # documents of the language that hold a kept term
    scale: int = 1_000_000_000
    prior: int = 2
    top: int = 10             # terms reported per group
    groups: int = 32          # groups of one block
    rare: int = 6             # terms of fewer than 2 ** rare occurrences have small counts
    rare_terms: int = 2048    # terms of one block, rare ones
    frequent_terms: int = 64  # and the others


def count_terms(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, count, docs): occurrences, and the rows that hold the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in record_batches(batches, "text", 4 << 20):
            texts = Texts(rb.column("text"), lower=True)
            starts, ends, first = texts.words(_GAP)
            if not len(starts):
                continue
            data = texts.data[~_GAP[texts.data]]
            offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
            terms = pa.LargeStringArray.from_buffers(
                len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
            width = len(terms.dictionary)
            doc = np.repeat(np.arange(texts.n), np.diff(first))
            pair, n = np.unique(doc * width + terms.indices.to_numpy(), return_counts=True)
            names = pa.StructArray.from_arrays([rb.column("lang"), rb.column("source")], names=["lang", "source"])
            group = _codes(names)
            key, at = np.unique(group[pair // width] * width + pair % width, return_inverse=True)
            row = np.zeros(group.max() + 1, dtype=np.int64)
            row[group] = np.arange(len(group))
            owner = pa.array(row[key // width])
            yield pa.RecordBatch.from_arrays(
                [rb.column("lang").take(owner), rb.column("source").take(owner),
                 terms.dictionary.take(pa.array(key % width)).cast(pa.string()),
                 pa.array(np.bincount(at, weights=n).astype(np.int64)), pa.array(np.bincount(at))],
                names=["lang", "source", "term", "count", "docs"])

    rows = docs.select(text_or_empty(lang).alias("lang"), text_or_empty(source).alias("source"),
                       text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, COUNTED).groupBy("lang", "source", "term").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _codes(names: pa.StructArray) -> np.ndarray:
    """A number for each distinct pair of names."""
    parts = [names.field(i).dictionary_encode() for i in range(2)]
    a, b = (p.indices.to_numpy().astype(np.int64) for p in parts)
    return np.unique(a * len(parts[1].dictionary) + b, return_inverse=True)[1]


def _share(count: Column, total: Column, terms: Column, params: DivergenceParams) -> Column:
    """1 + floor(scale * (count + prior) / (total + prior * terms)), in whole numbers."""
    top = F.lit(params.scale).cast("decimal(10,0)") * (count + params.prior).cast("decimal(20,0)")
    low = (total + params.prior * terms).cast("decimal(20,0)")
    return F.call_function("div", top, low) + 1


def _price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def price_tile(term: np.ndarray, group: np.ndarray, level: np.ndarray, p: np.ndarray, n_terms: int,
               groups_a: np.ndarray, groups_b: np.ndarray, zero: dict[int, int]) -> np.ndarray:
    """Summed price of each pair of ``groups_a`` and ``groups_b`` over a block of ``n_terms`` terms.

    Entries (term, group, level > 0, share p); ``zero`` has the share of a group's level 0.
    """
    rows, row = np.unique(term, return_inverse=True)

    def side(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Indicator columns, their shares, and where each group's columns begin."""
        blocks, shares, first = [], [], [0]
        for g in groups:
            own = group == g
            levels, at = np.unique(level[own], return_inverse=True)
            hot = np.zeros((len(rows), len(levels) + 1), dtype=np.float32)
            hot[:, 0] = 1
            hot[row[own], 0] = 0
            hot[row[own], at + 1] = 1
            price = np.empty(len(levels) + 1, dtype=np.int64)
            price[0] = zero[int(g)]
            price[at + 1] = p[own]
            blocks.append(hot)
            shares.append(price)
            first.append(first[-1] + len(price))
        return np.concatenate(blocks, axis=1), np.concatenate(shares), np.array(first[:-1])

    hot_a, p_a, first_a = side(groups_a)
    hot_b, p_b, first_b = side(groups_b)
    joint = (hot_a.T @ hot_b).astype(np.int64)
    # terms of the block that no group of this tile holds are at level 0 everywhere
    joint[np.ix_(first_a, first_b)] += n_terms - len(rows)
    gap = p_a[:, None] - p_b[None, :]
    gap *= gap
    gap //= p_a[:, None] + p_b[None, :]
    joint *= gap
    return np.add.reduceat(np.add.reduceat(joint, first_a, axis=0), first_b, axis=1)


def _price_group(tab: pa.Table) -> pa.Table:
    """One tile: header rows (no term) name the groups, the others are the entries."""
    lang, one, two = (tab.column(k)[0].as_py() for k in ("lang", "one", "two"))
    col = {k: tab.column(k).to_numpy() for k in ("gid", "block", "level", "p", "n_terms")}
    head = pc.is_null(tab.column("term")).to_numpy()
    body = ~head
    term = tab.column("term").combine_chunks().filter(pa.array(body)).dictionary_encode().indices.to_numpy()
    ids, at = np.unique(col["gid"][head], return_index=True)
    in_block = col["block"][head][at]
    a, b = ids[in_block == one], ids[in_block == two]
    value = price_tile(term, col["gid"][body], col["level"][body], col["p"][body], int(col["n_terms"][head][0]),
                       a, b, dict(zip(ids.tolist(), col["p"][head][at].tolist())))
    left, right = (x.ravel() for x in np.broadcast_arrays(a[:, None], b[None, :]))
    keep = left < right if one == two else np.ones(len(left), dtype=bool)
    return pa.table({"lang": pa.array([lang] * int(keep.sum()), pa.string()), "a": pa.array(left[keep], pa.int32()),
                     "b": pa.array(right[keep], pa.int32()), "value": pa.array(value.ravel()[keep], pa.int64())})


def _pair_values(entries: DataFrame, groups: DataFrame, blocks: DataFrame, params: DivergenceParams) -> DataFrame:
    """(lang, a, b, value) for a < b of languages with kept terms."""
    zero = _share(F.lit(0).cast("long"), F.col("total"), F.col("n_kept"), params)
    heads = (groups.join(blocks, "lang").select(
        "lang", "bucket", "lot", "gid", "block", "n_blocks", F.lit(None).cast("string").alias("term"),
        F.lit(0).cast("long").alias("level"), zero.alias("p"), "n_terms"))
    rows = heads.unionByName(entries.withColumn("n_terms", F.lit(0).cast("long")))
    rows = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select(
        "lang", "bucket", "lot", F.least("block", "_o").alias("one"), F.greatest("block", "_o").alias("two"),
        "gid", "block", "term", "level", "p", "n_terms")
    return (rows.groupBy("lang", "bucket", "lot", "one", "two").applyInArrow(_price_group, PRICED)
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))


def divergence(docs: DataFrame, params: DivergenceParams = DivergenceParams(), lang: str = "lang",
               source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): how far a group lies from the other sources of
    its language (part ``pair``), and the terms that set it apart from the language (``term``).

    Null texts, languages and sources count as empty ones; each row is a document, so
    repeated rows count as often as they stand. Ties go by the item's UTF-8 bytes. A group without
    terms has zero counts, one that is alone in its language no pairs; an empty table gives no rows.
    Other columns, whatever their names, are ignored.
    """
    docs = docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    found = stash(count_terms(docs))
    bucket = F.floor(F.log2(F.col("all"))).cast("int")
    kept = (found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("all"))
            .filter(F.col("docs") >= params.min_docs).select("lang", "term", "all", bucket.alias("bucket")))
    size = F.when(F.col("bucket") < params.rare, params.rare_terms).otherwise(params.frequent_terms)
    lots = kept.groupBy("lang", "bucket").agg(F.ceil(F.count("*") / size).cast("int").alias("lots"))
    kept = stash(kept.join(lots, ["lang", "bucket"]).withColumn(
        "lot", F.pmod(F.xxhash64("term"), "lots").cast("int")).drop("lots"))
    blocks = kept.groupBy("lang", "bucket", "lot").agg(F.count("*").alias("n_terms"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("n_kept"), F.sum("all").alias("lang_total"))

    held = stash(found.drop("docs").join(kept, ["lang", "term"]))
    totals = held.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    of_lang = Window.partitionBy("lang")
    groups = stash(
        docs.select(text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source")).distinct()
        .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total"),
                F.coalesce("n_kept", F.lit(0)).cast("long").alias("n_kept"), "lang_total", place.alias("gid"),
                F.ceil(F.count("*").over(of_lang) / params.groups).cast("int").alias("n_blocks"))
        .withColumn("block", F.expr(f"cast(gid div {params.groups} as int)")))

    counted = held.join(groups, ["lang", "source"]).withColumn(
        "p", _share(F.col("count"), F.col("total"), F.col("n_kept"), params))
    entries = counted.select("lang", "bucket", "lot", "gid", "block", "n_blocks", "term",
                             F.col("count").alias("level"), "p")
    sums = _pair_values(entries, groups.filter("n_kept > 0"), blocks, params)
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("gid").alias("b"))
    pairs = (groups.select("lang", "source", F.col("gid").alias("a")).join(other, "lang").filter("a <> b")
             .join(both, ["lang", "a", "b"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     F.coalesce("value", F.lit(0)).cast("long").alias("value")))
    q = _share(F.col("all"), F.col("lang_total"), F.col("n_kept"), params)
    terms = (counted.withColumn("q", q).filter("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     _price(F.col("p"), F.col("q")).alias("value")))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(
        terms.withColumn("rank", rank).filter(F.col("rank") <= params.top))
