"""SimHash near-duplicates through a segment-popcount grid.

A fingerprint's two 32-bit halves are cut into sixteen 2-bit segments each; a segment's number of set bits is 0, 1 or 2. The Manhattan
distance of two such vectors of counts never exceeds the fingerprints' Hamming distance. Fingerprints within 4 (or 5) bits are within a
Manhattan distance of 2 in one half at least, so in that half some grid point is at most one step from both. Every fingerprint is dealt to the grid points within one step; points with several
fingerprints are searched and each pair is verified exactly.

Texts: null and empty texts have fingerprint 0, and link like any other. Repeated rows each get a row. An empty table gives an empty
result. Columns other than the two named are ignored, so clashing names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritstone.llm._components import components
from gritstone.llm._memory import frugal
from gritstone.llm._store import keep
from gritstone.session import ship

#: Groups of a grid point up to this size are compared by shifted arrays, larger ones by search.
_SHIFT = 16
#: Rows of a grid point that one task holds; larger points are dealt out as pairs of blocks.
BLOCK = 8192


def shingle_hashes(text: str | None, words: int = 4) -> np.ndarray:
    """XXH64 (seed 42) of each shingle of lower-cased (A-Z) words, repeats included."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = [e + i for i, e in enumerate(accumulate(map(len, found)))]
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts, ends[words - 1 :])), np.uint64, len(found) - words + 1)


def majority(hashes: np.ndarray) -> int:
    """A bit is set if it is set in over half of the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, words: int = 4) -> int:
    """The majority of the shingles' hashes."""
    return majority(shingle_hashes(text, words))


def with_fingerprints(df: DataFrame, words: int = 4, text: str = "text", keep_columns: list[str] | None = None, out: str = "fp") -> DataFrame:
    """The kept columns and ``out``, the fingerprint as a signed long."""
    ship(df.sparkSession)
    kept = ["doc_id"] if keep_columns is None else keep_columns
    rows = df.select(*kept) if text in kept else df.select(*kept, F.col(text).alias("__text"))
    at = kept.index(text) if text in kept else len(kept)
    schema = df.select(*kept).withColumn(out, F.lit(0).cast("long")).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), pa.array(fps)], names=[*kept, out])

    return rows.mapInArrow(frugal(score), schema)


def grid_points(fp: Column) -> Column:
    """Keys of the grid points within one step of either half's vector of segment counts."""
    keys = []
    for half in range(2):
        bits = F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
        odd = F.lit(0x55555555)
        code = bits.bitwiseAND(odd) + F.shiftrightunsigned(bits, 1).bitwiseAND(odd)
        tag = F.lit(half << 40)
        steps = []
        for i in range(16):
            count = F.shiftrightunsigned(code, 2 * i).bitwiseAND(F.lit(3))
            steps.append(F.when(count < 2, code + F.lit(1 << 2 * i) + tag))
            steps.append(F.when(count > 0, code - F.lit(1 << 2 * i) + tag))
        keys += [code + tag, *steps]
    return F.array_compact(F.array(*keys))


def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges that connect what links of at most ``distance`` bits connect; one fewer than nodes at most."""
    rest, edges = fps, []
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            one = todo.pop()
            near = np.bitwise_count(rest ^ one) <= distance
            if near.any():
                found = rest[near]
                edges += [(one, x) for x in found]
                todo += list(found)
                rest = rest[~near]
    return edges


def _groups(keys: np.ndarray, fps: np.ndarray, distance: int) -> np.ndarray:
    """Edges within runs of equal keys, as an array of two columns."""
    if len(keys) < 2:
        return np.zeros((0, 2), np.int64)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    each = np.repeat(sizes, sizes)
    few = (each > 1) & (each <= _SHIFT)
    k, f, found = keys[few], fps[few], []
    for d in range(1, _SHIFT):
        if d >= len(k):
            break
        near = (k[d:] == k[:-d]) & (np.bitwise_count(f[d:] ^ f[:-d]) <= distance)
        if near.any():
            found.append(np.stack([f[:-d][near], f[d:][near]], axis=1))
    for s, n in zip(starts[sizes > _SHIFT], sizes[sizes > _SHIFT]):
        edges = forest(fps[s : s + n], distance)
        if edges:
            found.append(np.array(edges, np.uint64))
    if not found:
        return np.zeros((0, 2), np.int64)
    return np.unique(np.concatenate(found).view(np.int64), axis=0)


def links(vertices: DataFrame, distance: int = 4, block: int = BLOCK) -> DataFrame:
    """Distinct ``fp`` longs to edges (a, b) that connect just what pairs of at most ``distance`` (4 at most) bits connect.

    Exact for connectivity: every pair within the distance is compared in a grid point that both are dealt to, and a point's edges
    are a spanning forest of its links. A point with over ``block`` members is dealt out again as pairs of blocks.
    """
    if not 0 <= distance <= 5:
        raise ValueError("the grid of one step from each half serves distances up to 5")
    spark = vertices.sparkSession
    ship(spark)
    dealt = vertices.select(F.explode(grid_points(F.col("fp"))).alias("point"), "fp").repartition("point").sortWithinPartitions("point", "fp")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f, large = np.zeros(0, np.int64), np.zeros(0, np.uint64), None

        def out(edges: np.ndarray, point: int | None = None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([point] * len(edges), pa.int64()), pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["point", "a", "b"])

        def later(fps: np.ndarray, point: int) -> pa.RecordBatch:
            return out(np.stack([fps, fps], axis=1).view(np.int64), point)

        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            f = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if large is not None:
                n = int(np.searchsorted(k, large, "right"))
                if n:
                    yield later(f[:n], large)
                k, f = k[n:], f[n:]
                if not len(k):
                    continue
                large = None
            k, f = np.concatenate([held_k, k]), np.concatenate([held_f, f])
            cut = int(np.searchsorted(k, k[-1], "left"))
            if cut:
                yield out(_groups(k[:cut], f[:cut], distance))
            held_k, held_f = k[cut:], f[cut:]
            if len(held_k) > block:
                large = int(held_k[0])
                yield later(held_f, large)
                held_k, held_f = held_k[:0], held_f[:0]
        if len(held_k):
            yield out(_groups(held_k, held_f, distance))

    first = keep(dealt.mapInArrow(frugal(search), "point long, a long, b long"))
    edges = first.where("point is null").select("a", "b")
    sizes = first.where("point is not null").groupBy("point").count()
    if not sizes.isEmpty():
        edges = edges.unionByName(_blocks(first.where("point is not null").select("point", F.col("a").alias("fp")), sizes, distance, block))
    return edges.distinct()


def _blocks(members: DataFrame, sizes: DataFrame, distance: int, block: int) -> DataFrame:
    """Edges of large grid points: each pair of a point's blocks is one group."""

    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        edges = forest(pdf["fp"].to_numpy().view(np.uint64), distance)
        return pd.DataFrame(np.array(edges, np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    n = F.ceil(F.col("count") / F.lit(block // 2)).cast("int")
    dealt = members.join(sizes, "point").withColumn("n", n).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    keyed = other.select("point", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    return keyed.groupBy("point", "i", "j").applyInPandas(pair, "a long, b long")


def near_duplicates(df: DataFrame, words: int = 4, distance: int = 4, block: int = BLOCK) -> DataFrame:
    """doc_id, fp (long) and component_id, the smallest doc_id that links of at most ``distance`` bits reach."""
    prints = keep(with_fingerprints(df, words))
    firsts = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(firsts.select("fp"), distance, block))
    of = firsts.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    of = keep(of)
    least = of.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = of.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def one_of_each(df: DataFrame, words: int = 5, distance: int = 4) -> DataFrame:
    """The rows of ``df`` that stay when one document of each group does.

    The one of the smallest doc_id stays (null ids last), then the longest text, then the smallest hash of all columns; of rows
    that are equal in all columns one stays.
    """
    cols = df.columns
    order = F.struct(F.col("doc_id").isNull(), "doc_id", -F.coalesce(F.length("text"), F.lit(-1)), F.xxhash64(*cols))
    marked = keep(with_fingerprints(df.withColumn("__order", order), words, keep_columns=[*cols, "__order"], out="__own"))
    firsts = keep(marked.groupBy(F.col("__own").alias("fp")).agg(F.min("__order").alias("first")))
    roots = components(links(firsts.select("fp"), distance))
    of = keep(firsts.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = of.groupBy("root").agg(F.min("first").alias("stays"))
    stay = keep(of.join(least, "root").where("first = stays").select(F.col("root").alias("__root"), F.col("first").alias("__stays"), F.col("fp").alias("__fp")))
    kept = marked.join(stay, (F.col("__own") == F.col("__fp")) & F.col("__order").eqNullSafe(F.col("__stays")))
    return kept.dropDuplicates(["__root"]).select(*cols)
