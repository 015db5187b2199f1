"""Nearest neighbours by cosine, with a vantage-point tree for each shard.

Vectors are scaled to length 1, where a larger cosine is a smaller Euclidean distance. Of vectors of one direction the ``k + 1``
smallest ids are kept, which is all that an answer can hold. Points are dealt to the nearest of at most ``pivots`` vantage points, and
a cell with over ``shard_rows`` points to several shards; each shard gets a tree, which splits points by their distance from a vantage
point. A query first searches one shard of its nearest cell. What it finds there bounds its k-th distance, and it goes on only to cells
whose distances from their pivots (a ring) can hold something nearer by the triangle inequality. The same inequality leaves out sides
of a tree's splits. Both compare with the k-th distance divided by ``relax``: 1 is exact, more is faster and may miss neighbours.
Scores are recomputed in double precision on the original vectors.

Vectors that are null, zero or hold null or non-finite components take no part. Vectors of different lengths never meet. Repeated rows
are candidates of their own. Scores that agree in 12 decimals are ties, as rounding alone sets vectors of one direction apart; ties go to
the smaller id. An empty table gives an empty result. Columns other than the two are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritstone.llm._store import keep
from gritstone.session import ship

LEAF = 64
#: More than distances near 0 can be off.
_SLACK = 1e-7
#: Decimals of a score that decide; the rest is rounding.
DECIMALS = 12


class Tree:
    """Points with length 1 as rows; nodes as arrays in preorder."""

    def __init__(self, points: np.ndarray, seed: int = 5, leaf: int = LEAF):
        self.points, rng = points, np.random.default_rng(seed)
        self.order: list[np.ndarray] = []
        self.nodes: list[tuple[int, float, int, int, int, int]] = []  # vantage, split, inside, outside, leaf's first and last place
        at = 0
        stack = [(np.arange(len(points)), -1, 0)]
        while stack:
            own, parent, side = stack.pop()
            k = len(self.nodes)
            if parent >= 0:
                node = list(self.nodes[parent])
                node[2 + side] = k
                self.nodes[parent] = tuple(node)  # type: ignore[assignment]
            if len(own) <= leaf:
                self.nodes.append((-1, 0.0, -1, -1, at, at + len(own)))
                self.order.append(own)
                at += len(own)
                continue
            vantage = int(own[rng.integers(len(own))])
            own = own[own != vantage]
            d = distances(points[own], points[vantage][None])[:, 0]
            half = len(own) // 2  # by rank, so that points at equal distances are halved too
            by = np.argpartition(d, half)
            split = float(d[by[half]])
            self.nodes.append((vantage, split, -1, -1, 0, 0))
            stack.append((own[by[half:]], k, 1))
            stack.append((own[by[:half]], k, 0))
        self.places = np.concatenate(self.order) if self.order else np.zeros(0, np.int64)
        del self.order

    def search(self, queries: np.ndarray, k: int, relax: float = 1.0, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, point, distance) of each query's k nearest points and all that tie with the k-th, in no order; none is beyond ``within``."""
        n = len(queries)
        best = np.full((n, k), np.inf) if within is None else np.repeat(within.astype(float)[:, None], k, axis=1)
        last = best.max(axis=1)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def offer(q: np.ndarray, which: np.ndarray, d: np.ndarray) -> None:
            """d: distances of queries q to points which."""
            row, col = np.nonzero(d <= last[q, None] + _SLACK)
            if not len(row):
                return
            found.append((q[row], which[col], d[row, col]))
            near = np.unique(row)
            own = np.concatenate([best[q[near]], d[near]], axis=1)
            best[q[near]] = np.partition(own, k - 1, axis=1)[:, :k]
            last[q[near]] = best[q[near]].max(axis=1)

        # A stack of (node, queries, lower bound of their distance to what is below it).
        stack = [(0, np.arange(n), np.zeros(n))] if self.nodes else []
        while stack:
            node, q, bound = stack.pop()
            alive = bound * relax <= last[q] + _SLACK
            q = q[alive]
            if not len(q):
                continue
            vantage, split, inside, outside, lo, hi = self.nodes[node]
            if vantage < 0:
                which = self.places[lo:hi]
                if len(which):
                    offer(q, which, distances(queries[q], self.points[which]))
                continue
            d = distances(queries[q], self.points[[vantage]])
            offer(q, np.array([vantage]), d)
            d = d[:, 0]
            first = d <= split
            parent = bound[alive]
            # The farther side of each group goes on the stack first, so the nearer one is searched before it.
            for mask, near, far in ((first, inside, outside), (~first, outside, inside)):
                if mask.any():
                    stack.append((far, q[mask], np.maximum(parent[mask], np.abs(d[mask] - split))))
                    stack.append((near, q[mask], parent[mask]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        q, which, d = (np.concatenate(x) for x in zip(*found))
        good = d <= last[q] + _SLACK
        return q[good], which[good], d[good]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows of length 1."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def _valid(df: DataFrame, vector: str) -> DataFrame:
    """Vectors as doubles, without those that take no part."""
    v = F.col(vector).cast("array<double>")
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    return df.select(F.col("vec_id").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(finite)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled to length 1; by the largest component first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _direction(v: Column) -> Column:
    """What vectors of one direction share, but for rounding at the edge of a decimal."""
    scaled = F.transform(F.array(v), lambda x: F.transform(x, lambda c: c / F.array_max(F.transform(x, lambda y: F.abs(y)))))[0]
    length = lambda x: F.sqrt(F.aggregate(x, F.lit(0.0), lambda t, c: t + c * c))
    return F.transform(F.array(scaled), lambda x: F.transform(x, lambda c: F.round(c / length(x), DECIMALS + 1) + F.lit(0.0)))[0]


class Index:
    """``shards``: a written table with a row for each shard (dims, cell, sub, and the pickled tree, ids and vectors).

    ``cells`` has a few numbers for each pivot, with at most ``pivots`` of them for each length of vectors: dims to the pivots' rows,
    and for each pivot how many shards its cell has and the least and greatest distance of its points.
    """

    def __init__(self, shards: DataFrame, cells: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
        self.shards, self.cells = shards, cells


def build(df: DataFrame, k: int = 5, vector: str = "embedding", shard_rows: int = 8192, pivots: int = 256) -> Index:
    """An index of all vectors. Pivots are vectors of the smallest hashes, one for each ``shard_rows`` and at most ``pivots`` a length."""
    spark = df.sparkSession
    ship(spark)
    valid = _valid(df, vector).withColumn("dims", F.size("v"))
    # Spark cuts a group of one direction to its smallest ids before it shuffles it.
    alike = Window.partitionBy(_direction(F.col("v"))).orderBy("id")
    points = keep(valid.withColumn("n", F.row_number().over(alike)).where(F.col("n") <= k + 1).drop("n"))
    counts = {r["dims"]: r["n"] for r in points.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    wanted = {d: min(pivots, -(-n // shard_rows)) for d, n in counts.items()}
    by_hash = Window.partitionBy("dims").orderBy(F.xxhash64("v"), "id")
    chosen = points.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= pivots).select("dims", "v", "n").collect()
    at: dict[int, np.ndarray] = {}
    for d, most in wanted.items():
        at[d] = unit(np.array([r["v"] for r in sorted(chosen, key=lambda r: r["n"]) if r["dims"] == d and r["n"] <= most], float))
    shared = spark.sparkContext.broadcast(at)  # at most ``pivots`` vectors a length

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            cell, far = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for d in np.unique(dims):
                which = np.flatnonzero(dims == d)
                flat = batch.column(1).take(pa.array(which)).flatten().to_numpy(zero_copy_only=False).reshape(len(which), d)
                all_ = distances(unit(flat), shared.value[int(d)])
                cell[which] = all_.argmin(axis=1)
                far[which] = all_.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=["id", "v", "dims", "cell", "far"])

    placed = keep(points.select("id", "v", "dims").mapInArrow(assign, "id long, v array<double>, dims int, cell int, far double"))
    sizes = placed.groupBy("dims", "cell").agg(F.count("*").alias("n"), F.min("far").alias("lo"), F.max("far").alias("hi")).collect()
    cells = {d: (x, np.zeros(len(x), np.int64), np.full(len(x), np.inf), np.full(len(x), -np.inf)) for d, x in at.items()}
    for r in sizes:
        _, subs, lo, hi = cells[r["dims"]]
        subs[r["cell"]], lo[r["cell"]], hi[r["cell"]] = -(-r["n"] // shard_rows), r["lo"], r["hi"]
    table = [(r["dims"], r["cell"], -(-r["n"] // shard_rows)) for r in sizes]
    subs = F.broadcast(spark.createDataFrame(table, "dims int, cell int, subs long"))
    dealt = placed.join(subs, ["dims", "cell"]).withColumn("sub", F.pmod(F.xxhash64("id", "v"), F.col("subs")).cast("int"))

    def plant(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        vectors = np.stack(pdf["v"].to_numpy())
        blob = pickle.dumps((Tree(unit(vectors)), pdf["id"].to_numpy(np.int64), vectors))
        return pd.DataFrame({c: [int(pdf[c].iloc[0])] for c in ("dims", "cell", "sub")} | {"blob": [blob]})

    return Index(keep(dealt.groupBy("dims", "cell", "sub").applyInPandas(plant, "dims int, cell int, sub int, blob binary")), cells)


def _route(batches: Iterator[pa.RecordBatch], cells: dict, relax: float, first: bool) -> Iterator[pa.RecordBatch]:
    """The shards that each query goes to: one of its nearest cell, or all others that may hold what is as near as ``within``."""
    for batch in batches:
        dims, salt = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(zero_copy_only=False)
        within = batch.column(4).to_numpy(zero_copy_only=False)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for d in np.unique(dims):
            if int(d) not in cells:
                continue
            pivots, subs, lo, hi = cells[int(d)]
            which = np.flatnonzero(dims == d)
            q = unit(batch.column(1).take(pa.array(which)).flatten().to_numpy(zero_copy_only=False).reshape(len(which), d))
            far = distances(q, pivots)
            home = np.where(subs > 0, far, np.inf).argmin(axis=1)
            own = salt[which] % subs[home]
            if first:
                out.append((which, home, own))
                continue
            bound = np.maximum(0, np.maximum(far - hi, lo - far))
            row, cell = np.nonzero((bound * relax <= within[which, None] + _SLACK) & (subs > 0))
            each = np.repeat(np.arange(len(row)), subs[cell])
            sub = np.arange(len(each)) - np.repeat(np.cumsum(subs[cell]) - subs[cell], subs[cell])
            row, cell = row[each], cell[each]
            rest = (cell != home[row]) | (sub != own[row])
            out.append((which[row[rest]], cell[rest], sub[rest]))
        rows, cell, sub = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        for i in range(0, len(rows), 10_000):  # a query may go to many shards, so batches stay small
            part = batch.take(pa.array(rows[i : i + 10_000]))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell[i : i + 10_000].astype(np.int32)), pa.array(sub[i : i + 10_000].astype(np.int32))], names=[*part.schema.names, "cell", "sub"])


def _searched(index: Index, asked: DataFrame, k: int, relax: float, block: int, first: bool) -> DataFrame:
    """query_id, vec_id and score: the best ``k`` of each shard that a query goes to. ``asked``: id, v, dims, salt and within."""
    shared = asked.sparkSession.sparkContext.broadcast(index.cells)
    routed = asked.mapInArrow(lambda batches: _route(batches, shared.value, relax, first), "id long, v array<double>, dims int, salt long, within double, cell int, sub int")
    routed = keep(routed)
    counts = routed.groupBy("dims", "cell", "sub").agg(F.ceil(F.count("*") / F.lit(block)).alias("blocks"))
    dealt = routed.join(counts, ["dims", "cell", "sub"]).withColumn("block", F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int"))

    def bundle(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pickle.dumps((pdf["id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()), pdf["within"].to_numpy(float)))
        return pd.DataFrame({c: [int(pdf[c].iloc[0])] for c in ("dims", "cell", "sub")} | {"asked": [own]})

    bundles = dealt.groupBy("dims", "cell", "sub", "block").applyInPandas(bundle, "dims int, cell int, sub int, asked binary")
    pairs = keep(bundles).join(index.shards, ["dims", "cell", "sub"]).select("blob", "asked")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, own in zip(batch.column(0), batch.column(1)):
                tree, ids, vectors = pickle.loads(blob.as_py())
                qid, q, within = pickle.loads(own.as_py())
                # One more point than wanted, as a query may be a point itself.
                row, which, _ = tree.search(unit(q), k + 1, relax, within)
                cosine = lambda x, y: (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
                with np.errstate(over="ignore", invalid="ignore"):
                    scores = cosine(vectors[which], q[row])
                if not np.isfinite(scores).all():  # components whose squares overflow or vanish
                    scores = cosine(unit(vectors)[which], unit(q)[row])
                rest = ids[which] != qid[row]
                row, which, scores = row[rest], ids[which[rest]], scores[rest]
                order = np.lexsort((which, -np.round(scores, DECIMALS), row))
                row, which, scores = row[order], which[order], scores[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                top = place < k
                yield pa.RecordBatch.from_arrays([pa.array(qid[row[top]]), pa.array(which[top]), pa.array(scores[top])], names=["query_id", "vec_id", "score"])

    return pairs.mapInArrow(search, "query_id long, vec_id long, score double")


def nearest(index: Index, queries: DataFrame, k: int = 5, relax: float = 1.0, vector: str = "embedding", block: int = 2048) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k nearest points other than itself."""
    ship(queries.sparkSession)
    valid = _valid(queries, vector).dropDuplicates(["id", "v"])
    asked = keep(valid.select("id", "v", F.size("v").alias("dims"), F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("salt"), F.lit(float("inf")).alias("within")))
    home = keep(_searched(index, asked, k, relax, block, True))
    # The k-th distance so far; without k neighbours there is no bound.
    least = home.groupBy("query_id").agg(F.min("score").alias("s"), F.count("*").alias("n")).where(F.col("n") >= k)
    bound = F.coalesce(F.sqrt(F.greatest(2 - 2 * F.col("s"), F.lit(0.0))) + F.lit(_SLACK), F.lit(float("inf")))
    again = asked.drop("within").join(least, F.col("id") == F.col("query_id"), "left").select("id", "v", "dims", "salt", bound.alias("within"))
    found = home.unionByName(_searched(index, again, k, relax, block, False))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.round("score", DECIMALS).desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
