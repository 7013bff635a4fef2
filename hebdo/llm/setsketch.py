"""MinHash near-duplicates with SetSketch registers.

Each text becomes the set of its word shingles. A SetSketch keeps, per
register, the largest exponent ``1 - log_b(x)`` over exponentially spaced
hash values ``x`` of the elements (truncated to 16 bits), so sketches merge by
an element-wise maximum and equal registers estimate similarity. Bands of
registers name buckets. Documents of a bucket are paired with its centres, the
pairs estimated jointly from both sketches by likelihood, and what remains is
confirmed on the full shingle sets. Likely pairs tie documents into families.
Inside a family all documents of different components are compared block by
block within tasks that return links only; pairs of one bucket but two
families are joined under a bound on differing sketch bits. So no link that a
band sees is lost to the choice of a centre, and no group is expanded into all
its pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hebdo.llm.common import record_batches, stash
from hebdo.llm.components import connected_components
from hebdo.llm.tokens import Texts, mix, shingle_sets

_U = np.uint64
RATE, TOP = 20.0, 65534


@dataclass(frozen=True)
class SketchParams:
    """``bands * rows`` registers. With 60 bands of 7 a pair of similarity 0.8
    shares no band with probability (1 - 0.8**7)**60 = 7e-7."""

    shingle: int = 4
    similarity_pct: int = 80
    bands: int = 60
    rows: int = 7
    base: float = 1.001
    sigmas: float = 6.0

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def sketch(sets: list[np.ndarray], params: SketchParams) -> np.ndarray:
    """Registers (texts x registers, uint16) of hash sets; empty sets give zeros.

    Every element draws the points of a Poisson process of rate
    ``RATE * registers`` in ascending order and gives each to a random
    register, so each register sees independent exponentials. An element stops
    once its next point lies beyond every register of its text.
    """
    m = params.registers
    n = np.array([len(s) for s in sets], dtype=np.int64)
    low = np.full(len(sets) * m, np.inf)
    if n.sum():
        element = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), n)
        at = np.zeros(len(element))
        bound = np.full(len(sets), np.inf)
        step = 0
        while len(element):
            step += 1
            draw = mix(element + _U((step * 0x9E3779B97F4A7C15) & (2**64 - 1)))
            at = at - np.log(((draw >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / (RATE * m)
            keep = at < bound[owner]
            element, owner, at, draw = element[keep], owner[keep], at[keep], draw[keep]
            reg = (mix(draw ^ _U(0x5851F42D4C957F2D)) % _U(m)).astype(np.int64)
            np.minimum.at(low, owner * m + reg, at)
            if step < 16 or step % 8 == 0:
                bound = low.reshape(len(sets), m).max(axis=1)
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(low) / np.log(params.base))
    return np.clip(k + TOP // 2, 0, TOP).astype(np.uint16).reshape(len(sets), m)


def joint_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray,
                     base: float) -> np.ndarray:
    """Maximum-likelihood similarity of sketch pairs (pairs x registers) whose set sizes are known."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - above - below
    u = na / np.maximum(na + nb, 1)
    v = 1 - u

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 1e-12, 1) * (base - 1) / base) / np.log(base)

    best, arg = np.full(len(u), -np.inf), np.zeros(len(u))
    most = np.minimum(u / v, v / u)
    for t in np.linspace(0, 1, 101):
        j = t * most
        up, down = p(u - v * j), p(v - u * j)
        like = above * np.log(up) + below * np.log(down) + same * np.log(np.clip(1 - up - down, 1e-12, 1))
        arg = np.where(like > best, j, arg)
        best = np.maximum(best, like)
    return arg


def sketches(docs: DataFrame, params: SketchParams, id_col: str, text_col: str) -> DataFrame:
    """(id, n, d1, d2, registers, bits): set size, a 128-bit digest of the set, its sketch, and
    one bit of every register."""
    schema = "id long, n long, d1 long, d2 long, registers binary, bits array<long>"

    def run(batches):
        for rb in record_batches(batches, "text"):
            sets = shingle_sets(Texts(rb.column("text"), lower=True), params.shingle)
            regs = sketch(sets, params)
            with np.errstate(over="ignore"):
                d1 = np.array([mix(s).sum(dtype=_U) if len(s) else 0 for s in sets], dtype=_U)
                d2 = np.array([mix(s ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=_U) if len(s) else 0
                               for s in sets], dtype=_U)
            yield pa.RecordBatch.from_arrays(
                [rb.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                 pa.array([r.tobytes() for r in regs], pa.binary()), _bits(regs)],
                names=["id", "n", "d1", "d2", "registers", "bits"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _registers(column: pa.Array, m: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), m)


def _bits(regs: np.ndarray) -> pa.Array:
    low = np.zeros((len(regs), -(-regs.shape[1] // 64) * 64), dtype=np.uint8)
    low[:, :regs.shape[1]] = mix(regs.astype(_U)) & _U(1)
    low = np.packbits(low, axis=1).view(np.int64)
    return pa.ListArray.from_arrays(np.arange(0, len(regs) + 1, dtype=np.int32) * low.shape[1], pa.array(low.ravel()))


def bands(reps: DataFrame, params: SketchParams) -> DataFrame:
    """(key, id): one row per band of each sketch."""
    b, r, m = params.bands, params.rows, params.registers

    def run(batches):
        salt = mix(np.arange(1, b + 1, dtype=_U))
        for rb in batches:
            if not rb.num_rows:
                continue
            regs = _registers(rb.column("registers"), m).reshape(rb.num_rows, b, r).astype(_U)
            word = regs[:, :, 0]
            for j in range(1, r):
                word = mix(word * _U(0x9E3779B97F4A7C15) + regs[:, :, j])
            row = pa.array(np.repeat(np.arange(rb.num_rows), b))
            yield pa.RecordBatch.from_arrays(
                [pa.array(mix(word ^ salt).ravel().view(np.int64)), rb.column("id").take(row)], names=["key", "id"])

    return reps.select("id", "registers").mapInArrow(run, "key long, id long")


def _limit(params: SketchParams) -> float:
    """The joint estimate under which a pair is dropped: ``sigmas`` deviations below the similarity."""
    limit = params.similarity_pct / 100
    return limit - params.sigmas * (limit * (1 - limit) / params.registers) ** 0.5


def _may_be_near(x: str, y: str, params: SketchParams) -> str:
    """SQL condition on rows with n and bits: what set sizes and differing sketch bits allow."""
    m, pct = params.registers, params.similarity_pct
    apart = (1 - pct / 100) / 2
    most = int(m * apart + params.sigmas * (m * apart * (1 - apart)) ** 0.5)
    differ = " + ".join(f"bit_count({x}.bits[{i}] ^ {y}.bits[{i}])" for i in range(-(-m // 64)))
    return f"100 * least({x}.n, {y}.n) >= {pct} * greatest({x}.n, {y}.n) and {differ} <= {most}"


def _likely(pairs: DataFrame, reps: DataFrame, params: SketchParams) -> DataFrame:
    """The pairs that sizes, sketch bits and then the joint estimate leave."""
    limit, m = _limit(params), params.registers

    def run(batches):
        for rb in batches:
            if not rb.num_rows:
                continue
            size = [rb.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("na", "nb")]
            keep = joint_similarity(_registers(rb.column("ra"), m), _registers(rb.column("rb"), m),
                                    *size, params.base) >= limit
            yield rb.select(["a", "b"]).filter(pa.array(keep))

    slim = reps.select("id", "n", "bits")
    pairs = stash(pairs.join(slim.alias("x"), F.expr("a = x.id")).join(
        slim.alias("y"), F.expr("b = y.id and " + _may_be_near("x", "y", params))).select("a", "b"))
    one = reps.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    two = reps.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
    return (pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "ra", "rb")
            .mapInArrow(run, "a long, b long"))


def _linked(x: np.ndarray, y: np.ndarray, pct: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= pct * (len(x) + len(y) - both)


FILTER_BITS = 1 << 25


def _sets(docs: DataFrame, ids: DataFrame, params: SketchParams) -> DataFrame:
    """(id, shingles) of the named documents. A bitmap of fixed size over the hashed ids
    (4 MB, whatever the number of ids) drops most other texts before anything is shuffled;
    the join settles the rest."""
    spot = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    place = spot + 1  # bitmap buckets start at 1 for the value 1; 0 would be in a bucket 0 of its own
    maps = (ids.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect())
    width = 4096 * 8
    marked = np.zeros(FILTER_BITS + width, dtype=bool)
    for bucket, bits in maps:
        lo = (bucket - 1) * width
        marked[lo:lo + width] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), bitorder="little")
    packed = np.packbits(marked)

    def run(batches):
        for rb in record_batches(batches, "text"):
            at = rb.column("place").to_numpy(zero_copy_only=False)
            rb = rb.filter(pa.array((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)))
            if rb.num_rows:
                sets = shingle_sets(Texts(rb.column("text"), lower=True), params.shingle)
                yield pa.RecordBatch.from_arrays(
                    [rb.column("id"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "shingles"])

    return (docs.select("id", "text", spot.cast("long").alias("place")).mapInArrow(run, "id long, shingles binary")
            .join(ids, "id", "left_semi"))


def _confirm(pairs: DataFrame, sets: DataFrame, params: SketchParams) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""

    def run(batches):
        for rb in batches:
            keep = [_linked(np.frombuffer(x.as_buffer(), dtype=_U), np.frombuffer(y.as_buffer(), dtype=_U),
                            params.similarity_pct) for x, y in zip(rb.column("sa"), rb.column("sb"))]
            yield rb.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _within_families(members: DataFrame, params: SketchParams, rows: int = 256, shingles: int = 1 << 17) -> DataFrame:
    """Links between different components of one family; members(family, id, comp, n, registers, shingles).

    Every pair that crosses components has a side outside the family's largest one. So the
    documents outside it, in blocks, meet all members, in blocks of at most about ``rows``
    documents and ``shingles`` shingles: a family with few outsiders moves in proportion
    to its size. Each task estimates its cross pairs from the sketches and confirms the likely
    ones on the sets, but for those whose components a link of that task has joined. Only
    links leave the task.
    """
    limit, m, pct = _limit(params), params.registers, params.similarity_pct
    of_comp = members.groupBy("family", "comp").agg(F.count("*").alias("size"), F.sum("n").alias("mass"))
    sizes = (of_comp.groupBy("family").agg(
        F.count("*").alias("comps"), F.sum("size").alias("size"), F.sum("mass").alias("mass"),
        F.max(F.struct("size", "comp", "mass")).alias("main")).filter("comps > 1"))
    blocks = lambda size, mass: F.expr(f"cast(ceil(greatest(({size}) / {rows}, ({mass}) / {shingles})) as int)")
    dealt = members.join(sizes.select(
        "family", F.col("main.comp").alias("largest"), blocks("size", "mass").alias("lefts"),
        blocks("size - main.size", "mass - main.mass").alias("rights")), "family")
    spot = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    columns = ["family", "p", "q", "outside", "id", "comp", "n", "registers", "shingles"]
    dealt = dealt.withColumn("outside", F.col("comp") != F.col("largest"))
    left = (dealt.withColumn("p", (spot % F.col("lefts")).cast("int"))
            .withColumn("q", F.explode(F.expr("sequence(0, rights - 1)"))).withColumn("side", F.lit(0)))
    right = (dealt.filter("outside").withColumn("q", (spot % F.col("rights")).cast("int"))
             .withColumn("p", F.explode(F.expr("sequence(0, lefts - 1)"))).withColumn("side", F.lit(1)))

    def run(tab: pa.Table) -> pa.Table:
        tab = tab.combine_chunks()
        regs = np.stack([np.frombuffer(r.as_buffer(), dtype=np.uint16) for r in tab["registers"]])
        ids, comp, n, side = (tab[c].to_numpy() for c in ("id", "comp", "n", "side"))
        outside = tab["outside"].to_numpy(zero_copy_only=False)
        here = np.flatnonzero(side == 0)
        joined: dict[int, int] = {}

        def root(c: int) -> int:
            while c in joined:
                c = joined[c]
            return c

        def full(i: int) -> np.ndarray:
            return np.frombuffer(tab["shingles"][int(i)].as_buffer(), dtype=_U)

        out, first, second, waiting = [], [], [], 0

        def settle() -> None:
            x, y = np.concatenate(first), np.concatenate(second)
            est = joint_similarity(regs[x], regs[y], n[x].astype(float), n[y].astype(float), params.base)
            for k, i in zip(x[est >= limit], y[est >= limit]):
                a, b = root(int(comp[k])), root(int(comp[i]))
                if a != b and _linked(full(k), full(i), pct):
                    joined[max(a, b)] = min(a, b)
                    out.append((int(ids[k]), int(ids[i])))

        for i in np.flatnonzero(side == 1):
            # a pair of two outsiders meets twice; the one with the larger id on the left counts
            js = here[(comp[here] != comp[i]) & (~outside[here] | (ids[here] > ids[i]))
                      & (100 * np.minimum(n[here], n[i]) >= pct * np.maximum(n[here], n[i]))]
            if len(js):
                js = js[np.count_nonzero(regs[js] == regs[i], axis=1) >= (limit - 0.05) * m]
                first.append(js)
                second.append(np.full(len(js), i))
                waiting += len(js)
            if waiting >= 4096:
                settle()
                first, second, waiting = [], [], 0
        if waiting:
            settle()
        return pa.table({"a": pa.array([k for k, _ in out], pa.int64()),
                         "b": pa.array([o for _, o in out], pa.int64())})

    return (left.select(*columns, "side").unionByName(right.select(*columns, "side"))
            .repartition("family", "p", "q")  # else a large family stays where the join by family put it
            .groupBy("family", "p", "q").applyInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, params: SketchParams | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id, kept), one row per row of ``docs``.

    Null and empty texts have an empty set: linked with nothing, their own
    component, kept. Rows with a null id come back with a null component and
    kept (they can't be named as anyone's copy). Repeated ids are taken as
    copies if their texts agree; other columns are ignored.
    """
    params = params or SketchParams()
    texts = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    every = stash(sketches(docs, params, id_col, text_col))
    reps = stash(every.filter("n > 0 and id is not null").groupBy("d1", "d2", "n")
                 .agg(F.min("id").alias("id"), F.min("registers").alias("registers"), F.min("bits").alias("bits")))

    in_bucket = Window.partitionBy("key")
    buckets = stash(bands(reps, params)
                    .withColumn("lo", F.min("id").over(in_bucket)).withColumn("hi", F.max("id").over(in_bucket))
                    .filter("lo < hi"))
    star = (buckets.select(F.col("lo").alias("a"), F.col("id").alias("b"))
            .union(buckets.select("id", "hi")).filter("a < b").distinct())
    star = stash(_likely(star, reps, params))
    families = stash(connected_components(star).withColumnRenamed("component", "family"))

    # pairs of one bucket that lie in different families
    rows = buckets.select("key", "id").join(families, "id", "left").withColumn("family", F.coalesce("family", "id"))
    split = (rows.groupBy("key").agg(F.min("family").alias("f0"), F.max("family").alias("f1"))
             .filter("f0 < f1").select("key"))
    rows = stash(rows.join(split, "key").join(reps.select("id", "n", "bits"), "id"))
    across = (rows.alias("x").join(rows.alias("y"), F.expr(
        "x.key = y.key and x.family < y.family and " + _may_be_near("x", "y", params)))
        .select(F.expr("least(x.id, y.id)").alias("a"), F.expr("greatest(x.id, y.id)").alias("b")).distinct())
    pairs = stash(star.union(_likely(across, reps, params)))

    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    sets = stash(_sets(texts, ids, params).dropDuplicates(["id"]))
    links = stash(_confirm(pairs, sets, params))
    comp = connected_components(links)
    members = (families.join(sets, "id").join(reps.select("id", "n", "registers"), "id").join(comp, "id", "left")
               .select("family", "id", F.coalesce("component", "id").alias("comp"), "n", "registers", "shingles"))
    more = stash(_within_families(members, params))
    # components of components: the few links found last join what is there already
    c = connected_components(more.join(comp.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a", "left")
                             .join(comp.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b", "left")
                             .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    c = c.withColumnRenamed("id", "comp").withColumnRenamed("component", "root")

    classes = (reps.select("d1", "d2", "n", F.col("id").alias("rep"))
               .join(comp.withColumnRenamed("id", "rep"), "rep", "left")
               .withColumn("comp", F.coalesce("component", "rep")).join(c, "comp", "left")
               .select("d1", "d2", "n", F.coalesce("root", "comp").alias("component_id")))
    out = every.select("id", "n", "d1", "d2").join(classes, ["d1", "d2", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
