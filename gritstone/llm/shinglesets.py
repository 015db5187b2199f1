"""Near-duplicates by the Jaccard similarity of sets of word shingles.

A set is the distinct 64-bit hashes of a text's shingles; its ``SKETCH`` smallest hashes and the text's SimHash fingerprint go with it.
Two sets of a similarity of 0.8 share ``ALIKE`` of these at least, but for a chance of 4e-10. So they also share one of the others
where as many as ``ALIKE - 1`` of either sketch are left out. Those left out are hot ones first, which the most sets have, then
the largest; the rest are dealt out. Each pair that shares a dealt hash is a candidate, and is verified on the whole sets.

The first pairs are those of the fingerprints' segment-popcount grid (``simhash.links``): sets of one fingerprint, and of two within
``GRID_BITS`` bits. Of sets of a similarity of 0.8 few are that near, so the steps from here on search the rest. They begin with cheap
guesses: among the sets of a hash, each with its predecessor by size whose fingerprint is nearest. The grid and the guesses
connect most of what is similar, once their pairs are verified. Then come all pairs that share a dealt hash, are not connected yet, and whose sketches allow the
similarity: hashes of few sets give them one by one. The sets of other hashes (a passage that many texts have, say) are dealt anew
by finer sketches of ``FINE`` hashes, the rarest first, which leave out up to four fifths of a set. Hashes that many sets still share
then have sets that meet in blocks, first as sketches, to find out which have such a partner at all, then as whole sets, which are
compared there. A block gives a forest of its links, not its pairs.

Sets are told apart by a 64-bit hash. Texts without a word have the empty set, and are copies of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritstone.llm._components import components
from gritstone.llm._memory import frugal
from gritstone.llm._store import drop, keep
from gritstone.llm.simhash import links as grid_links
from gritstone.llm.simhash import majority, shingle_hashes
from gritstone.session import ship

SKETCH = 32
#: How many hashes the sketches of sets of a similarity of 0.8 share but for a chance of 4e-10.
ALIKE = 10
#: The same of the finer sketches of sets that share a hash with many; the chance is 4e-11.
FINE, FINE_ALIKE = 256, 160
#: Sets that a hash must have at least to be hot, and how many hashes can be hot: more sets are asked for then.
HOT, MOST_HOT = 256, 1_000_000
#: Bits within which the grid finds all fingerprints.
GRID_BITS = 5
#: Predecessors by size that a set is compared with for the first guesses, and bits that a guess may differ in.
NEAR, BITS = 8, 20
#: Hashes of so many sets at most give pairs one by one.
FEW = 16
#: Sets of a hash that one task holds.
BLOCK = 512


def shingle_set(text: str | None, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, words))


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Jaccard similarity of two sets in order, at least ``least``."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both) - 1e-9


def with_sets(df: DataFrame, words: int, text: str = "text") -> DataFrame:
    """The columns but the text, the set's hash ``id``, its ``size``, its smallest hashes ``least`` and the fingerprint ``fp``."""
    ship(df.sparkSession)
    others = [c for c in df.columns if c != text]
    schema = df.selectExpr(*others, "0L as id", "0L as size", "array(0L) as least", "0L as fp").schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, size, least, prints = [], [], [], []
            for t in batch.column(len(others)):
                hashes = shingle_hashes(t.as_py(), words)
                found = np.unique(hashes)
                own.append(xxhash.xxh3_64_intdigest(found.tobytes()))
                size.append(len(found))
                least.append(found[:SKETCH].view(np.int64))
                prints.append(majority(hashes))
            more = [pa.array(np.array(own, np.uint64).view(np.int64)), pa.array(size, pa.int64()), pa.array(least, pa.list_(pa.int64())), pa.array(np.array(prints, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], *more], names=[*others, "id", "size", "least", "fp"])

    return df.select(*others, text).mapInArrow(frugal(score), schema)


def verified(pairs: DataFrame, texts: DataFrame, words: int, least: float) -> DataFrame:
    """The pairs (a, b) of ids whose texts' sets are similar enough."""
    ship(pairs.sparkSession)
    rows = pairs.join(texts.toDF("a", "__ta"), "a").join(texts.toDF("b", "__tb"), "b").select("a", "b", "__ta", "__tb")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}

        def of(key, text) -> np.ndarray:
            found = known.get(key.as_py())
            if found is None:
                if len(known) >= 64:
                    known.clear()
                found = known[key.as_py()] = shingle_set(text.as_py(), words)
            return found

        for batch in batches:
            good = [similar(of(i, x), of(j, y), least) for i, j, x, y in zip(*batch.columns)]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return rows.mapInArrow(frugal(check), "a long, b long")


def dealt_hashes(sketch: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """What is dealt out of a sketch (signed, in unsigned order): all but ``ALIKE - 1``, hot ones first, then the last.

    Sketches with less than ``SKETCH`` hashes are whole sets, of which sets of a similarity of 0.8 share four fifths.
    """
    out = ALIKE - 1 if len(sketch) == SKETCH else max(0, -(-4 * len(sketch) // 5) - 1)
    at = np.minimum(np.searchsorted(hot, sketch), max(0, len(hot) - 1))
    is_hot = hot[at] == sketch if len(hot) else np.zeros(len(sketch), bool)
    keep_ = np.ones(len(sketch), bool)
    keep_[np.argsort(is_hot, kind="stable")[::-1][:out]] = False
    return sketch[keep_]


def _common(lists: list[np.ndarray], chunk: int = 1024) -> np.ndarray:
    """How many elements each two of the lists of distinct numbers share."""
    n = len(lists)
    at = np.repeat(np.arange(n), [len(x) for x in lists])
    found, where, count = np.unique(np.concatenate(lists) if n else np.zeros(0), return_inverse=True, return_counts=True)
    several = count[where] > 1
    at, column = at[several], (np.cumsum(count > 1) - 1)[where[several]]
    order = np.argsort(column, kind="stable")
    at, column = at[order], column[order]
    shared = np.zeros((n, n), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, chunk):
        a, b = np.searchsorted(column, [lo, lo + chunk])
        part = np.zeros((n, chunk), np.float32)
        part[at[a:b], column[a:b] - lo] = 1
        shared += part @ part.T
    return shared


def _with_partners(pdf: pd.DataFrame, least: float) -> pd.DataFrame:
    """The sets of two blocks of a hash that have a partner of another root, by sizes and sketches, whose first dealt hash in common this is."""
    pdf = pdf.drop_duplicates("id")
    sizes, roots, token = pdf["size"].to_numpy(), pdf["root"].to_numpy(), pdf["token"].iloc[0]
    larger = np.maximum.outer(sizes, sizes)
    good = _common([np.asarray(x, np.int64) for x in pdf["least"]]) >= np.where(larger <= FINE, least * larger - 1e-9, FINE_ALIKE)
    good &= np.minimum.outer(sizes, sizes) >= least * larger - 1e-9
    good &= roots[:, None] != roots[None]
    del larger
    if good.any():
        good &= _common([x[x < token] for x in (np.asarray(y, np.int64) for y in pdf["dealt"])]) == 0
    return pdf.loc[good.any(axis=1), ["token", "i", "j", "id", "root"]]


def _forest(pdf: pd.DataFrame, least: float) -> pd.DataFrame:
    """Edges that connect what links of similar sets connect, beside equal roots."""
    ids, roots = pdf["id"].to_numpy(), pdf["root"].to_numpy()
    sets = [np.asarray(x, np.int64) for x in pdf["hashes"]]
    both, sizes = _common(sets), np.array([len(x) for x in sets])
    similar_ = both >= least * (sizes[:, None] + sizes[None] - both) - 1e-6
    _, label = np.unique(roots, return_inverse=True)
    edges: list[tuple[int, int]] = []
    for a in range(len(ids)):
        for b in np.flatnonzero(similar_[a] & (label != label[a])):
            if label[b] != label[a]:
                edges.append((min(ids[a], ids[b]), max(ids[a], ids[b])))
                label[label == label[b]] = label[a]
    return pd.DataFrame(edges, columns=["a", "b"])


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _dealt(sets: DataFrame, hot: np.ndarray) -> DataFrame:
    """token, id, size and fp of each set's dealt hashes."""
    shared = sets.sparkSession.sparkContext.broadcast(hot)  # MOST_HOT numbers at most

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [dealt_hashes(x.values.to_numpy(zero_copy_only=False), shared.value) for x in batch.column(3)]
            which = pa.array(np.repeat(np.arange(len(own)), [len(x) for x in own]))
            tokens = pa.array(np.concatenate(own) if own else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([tokens, *(batch.column(i).take(which) for i in range(3))], names=["token", "id", "size", "fp"])

    return sets.select("id", "size", "fp", "least").mapInArrow(frugal(deal), "token long, id long, size long, fp long")


def grid_pairs(sets: DataFrame, bits: int = GRID_BITS) -> DataFrame:
    """Pairs (a, b) of ids by the fingerprints' grid: of one fingerprint each set with the first, and the firsts of fingerprints that it links."""
    sets = sets.select("id", "fp")
    firsts = keep(sets.groupBy("fp").agg(F.min("id").alias("first")), narrow=True)
    same = sets.join(firsts, "fp").where("id <> first").select(*_pair("id", "first"))
    near = grid_links(firsts.select("fp"), bits).toDF("x", "y")
    near = near.join(firsts.toDF("x", "o"), "x").join(firsts.toDF("y", "p"), "y").select(*_pair("o", "p"))
    return same.unionByName(near)


def links(sets: DataFrame, texts_of, words: int, least: float = 0.8, block: int = BLOCK, hot_sets: int = HOT) -> DataFrame:
    """Edges (a, b) that connect just what similar pairs connect. ``sets``: a written table of distinct id, size, least and fp.

    ``texts_of`` gives (id, text) of a table of ids. ``least`` is 0.8 or more.
    """
    if not 0.8 <= least <= 1:
        raise ValueError("the numbers of smallest hashes serve similarities from 0.8 on")
    spark = sets.sparkSession
    ship(spark)
    counts = keep(sets.select(F.explode("least").alias("token")).groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), narrow=True)
    total = sets.select(F.sum(F.size("least")).alias("n")).first()["n"] or 0
    hot = counts.where(F.col("n") > max(hot_sets, total // MOST_HOT)).select("token").toPandas()["token"].to_numpy(np.int64)
    hot = np.sort(hot)
    shared = keep(_dealt(sets, hot).join(counts, "token"), narrow=True)
    drop(counts)
    fits = F.col("o.size") >= least * F.col("size") - 1e-9
    # The grid's pairs, and guesses: each set with the predecessor of the nearest fingerprint.
    salt = F.pmod(F.xxhash64("id", "token"), F.ceil(F.col("n") / F.lit(block)))
    before = Window.partitionBy("token", "salt").orderBy("size", "id").rowsBetween(-NEAR, -1)
    near = shared.withColumn("salt", salt).withColumn("found", F.collect_list(F.struct("id", "size", "fp")).over(before)).select("id", "size", "fp", F.explode("found").alias("o"))
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("o.fp")))
    best = near.where(fits & (bits <= BITS)).groupBy("id").agg(F.min(F.struct(bits.alias("bits"), F.col("o.id").alias("o"))).alias("best"))
    guesses = best.select(*_pair("id", "best.o"))
    edges = _checked(grid_pairs(sets).unionByName(guesses), texts_of, words, least)
    # What these have not connected.
    roots = components(edges)
    rooted = keep(shared.join(roots, F.col("id") == F.col("node"), "left").select("token", "id", "size", "n", F.coalesce("root", "id").alias("root")), narrow=True)
    drop(shared)
    rest = _apart(rooted)
    drop(rooted)
    singly = _singly(rest.where(F.col("n") <= FEW), sets, SKETCH, ALIKE, texts_of, words, least)
    many = keep(rest.where(F.col("n") > FEW).select("id", "root").distinct(), narrow=True)
    drop(rest)
    finer = _finer(many, texts_of, words, least, block)
    drop(many)
    return edges.unionByName(singly).unionByName(finer)


def _apart(rows: DataFrame) -> DataFrame:
    """The rows of the hashes whose sets are not all connected, written."""
    return keep(rows.join(rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("token"), "token"), narrow=True)


def _singly(few: DataFrame, sketches: DataFrame, length: int, alike: int, texts_of, words: int, least: float) -> DataFrame:
    """Links of the pairs among the sets of each hash, which has ``FEW`` at most. ``sketches``: id and its ``length`` smallest hashes."""
    all_before = Window.partitionBy("token").orderBy("size", "id").rowsBetween(-FEW, -1)
    fits = (F.col("o.size") >= least * F.col("size") - 1e-9) & (F.col("o.root") != F.col("root"))
    pairs = few.withColumn("found", F.collect_list(F.struct("id", "size", "root")).over(all_before)).select("id", "size", "root", F.explode("found").alias("o"))
    pairs = pairs.where(fits).select(*_pair("id", "o.id"), "size").distinct()
    sketches = sketches.select("id", "least")
    both = pairs.join(sketches.toDF("a", "la"), "a").join(sketches.toDF("b", "lb"), "b")
    need = F.when(F.col("size") <= length, least * F.col("size") - 1e-9).otherwise(alike)
    return _checked(both.where(F.size(F.array_intersect("la", "lb")) >= need).select("a", "b"), texts_of, words, least)


def left_out(size: Column) -> Column:
    """How many of a finer sketch's hashes are not dealt. Sets well below ``FINE`` hashes are whole in theirs, and share four fifths."""
    return F.when(size * 5 < 4 * FINE, F.greatest(F.lit(0), F.floor((size * 4 + 4) / 5).cast("int") - 1)).otherwise(FINE_ALIKE - 1)


def finely_dealt(fine: DataFrame) -> DataFrame:
    """token, id, size of the hashes that finer sketches (id, size, least) deal out: the rarest first, of those that several have."""
    tokens = fine.select("id", "size", F.explode("least").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    own = Window.partitionBy("id")  # FINE rows at most
    ranked = tokens.join(counts, "token").withColumn("several", F.count("*").over(own)).withColumn("at", F.row_number().over(own.orderBy("n", "token")))
    return ranked.where(F.col("at") <= F.col("several") - left_out(F.col("size"))).select("token", "id", "size")


def _finer(ids: DataFrame, texts_of, words: int, least: float, block: int) -> DataFrame:
    """Links among the sets of ``ids`` (id, root) by finer sketches."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), words) for t in batch.column(1)]
            arrays = [pa.array([len(x) for x in sets], pa.int64()), pa.array([x[:FINE].view(np.int64) for x in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", "size", "least"])

    fine = keep(texts_of(ids.select("id")).select("id", "text").mapInArrow(frugal(sketch), "id long, size long, least array<long>"))
    dealt = keep(finely_dealt(fine).join(ids, "id"), narrow=True)
    rows = _apart(dealt)
    drop(dealt)
    numbers = rows.groupBy("token").agg(F.count("*").alias("n"))
    rest = keep(rows.join(numbers, "token"), narrow=True)
    drop(rows)
    singly = _singly(rest.where(F.col("n") <= FEW), fine, FINE, FINE_ALIKE, texts_of, words, least)
    many = rest.where(F.col("n") > FEW)
    sketches = keep(many.groupBy("id").agg(F.collect_set("token").alias("dealt")).join(fine.select("id", "least"), "id"))
    blocks = _in_blocks(many, sketches, texts_of, words, least, block)
    drop(fine, rest, sketches)
    return singly.unionByName(blocks)


def _in_blocks(rows: DataFrame, sketches: DataFrame, texts_of, words: int, least: float, block: int) -> DataFrame:
    """Links among the sets of hashes that many have: each two blocks of a hash's sets are one group. ``sketches``: id, least and dealt."""
    parts = F.ceil(F.col("n") / F.lit(max(1, block // 2))).cast("int")
    own = rows.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keyed = dealt.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "size", "root").join(sketches, "id")
    schema = "token long, i int, j int, id long, root long"
    members = keep(keyed.groupBy("token", "i", "j").applyInPandas(lambda pdf: _with_partners(pdf, least), schema))
    ids = members.select("id").distinct()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                hashes = [shingle_set(t.as_py(), words).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(hashes, pa.list_(pa.int64()))], names=["id", "hashes"])

    sets = keep(texts_of(ids).select("id", "text").mapInArrow(frugal(whole), "id long, hashes array<long>"))
    found = members.join(sets, "id").groupBy("token", "i", "j").applyInPandas(lambda pdf: _forest(pdf, least), "a long, b long")
    out = keep(found.distinct(), narrow=True)
    drop(members, sets)
    return out


def _checked(pairs: DataFrame, texts_of, words: int, least: float) -> DataFrame:
    pairs = keep(pairs.distinct(), narrow=True)
    if pairs.isEmpty():
        return pairs
    texts = keep(texts_of(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()))
    out = keep(verified(pairs, texts, words, least))
    drop(pairs, texts)
    return out


def one_of_each(df: DataFrame, words: int = 5, least: float = 0.8, block: int = BLOCK, hot_sets: int = HOT) -> DataFrame:
    """The rows of ``df`` that stay when one document of each group of similar ones does.

    The one of the smallest doc_id stays (null ids last), then the longest text, then the smallest hash of all columns; of rows
    that are equal in all columns one stays. Texts are moved for pairs to verify and once in the end; all else works on narrow tables.
    """
    cols = df.columns
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("key"), (-F.coalesce(F.length("text"), F.lit(-1))).alias("size"), F.xxhash64(*cols).alias("h"))
    prints = keep(with_sets(df.select(order.alias("first"), "text"), words))
    firsts = keep(prints.groupBy("id").agg(F.min("first").alias("first"), F.min("size").alias("size"), F.min("least").alias("least"), F.min("fp").alias("fp")))
    several = keep(prints.groupBy("first").count().where("count > 1").select("first"), narrow=True)
    repeated = not several.isEmpty()
    drop(prints)
    rows = df.select(order.alias("own"), "text")

    def texts_of(ids: DataFrame) -> DataFrame:
        want = ids.join(firsts, "id").select("id", "first")
        found = rows.join(want, F.col("own").eqNullSafe(F.col("first"))).select("id", "text")
        return found.dropDuplicates(["id"]) if repeated else found

    roots = components(links(firsts, texts_of, words, least, block, hot_sets))
    of = firsts.join(roots, F.col("id") == F.col("node"), "left").select("first", F.coalesce("root", "id").alias("root"))
    stay = keep(of.groupBy("root").agg(F.min("first").alias("stays")).select("stays"), narrow=True)
    drop(firsts)
    # Columns go by number, so that no name of the input can clash.
    numbered = df.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(cols)), order.alias("own"))
    kept = numbered.join(stay, F.col("own").eqNullSafe(F.col("stays")))
    if repeated:  # of equal rows, one
        is_several = F.col("own").eqNullSafe(F.col("first"))
        kept = kept.join(several, is_several, "left_anti").unionByName(kept.join(several, is_several, "left_semi").dropDuplicates(["own"]))
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(cols)))
