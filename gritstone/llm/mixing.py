"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sources get targets from their weights, none above ``repeats`` times its own size (the excess is shared anew by weight). A source's
documents are dealt by hash to shards, and a shard's words, laid out in a seeded order of its documents, are cut into blocks of nearly
equal length (its length over the number of blocks). Blocks go to sources by the highest quotients target / (2 k + 1), then a
source's blocks go to its shards in the same way, as integer quotas. Within a shard, every block is taken quota // blocks times, and
those that come first in a seeded permutation once more.

The driver holds a row for each source and shard: at most ``max_sources`` and about ``max_shards``, whatever the data's size (shards
grow instead). Documents are only read twice and shuffled once, without their text unless it is asked for.

Null and empty texts have size 0 and are taken 0 times. A null source is a source like others, last in order. Repeated rows are
documents of their own. An empty table gives an empty result. More columns than those used don't matter to ``mix``.
"""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gritstone.llm._memory import frugal
from gritstone.llm._store import keep
from gritstone.session import ship

WORD = r"[^\x20\x09-\x0D]+"


def water_fill(weights: list[float], caps: list[float], total: float) -> list[float]:
    """Shares of ``total`` by weight, none above its cap; the excess is shared anew by weight until none is above."""
    shares, open_, left = [0.0] * len(caps), set(range(len(caps))), total
    while open_:
        unit = left / sum(weights[i] for i in open_)
        above = [i for i in sorted(open_) if unit * weights[i] > caps[i]]
        if not above:
            for i in open_:
                shares[i] = unit * weights[i]
            break
        for i in above:
            shares[i] = float(caps[i])
            left -= caps[i]
            open_.remove(i)
        left = max(left, 0.0)
    return shares


def sainte_lague(votes: list[float], seats: int, caps: list[int] | None = None) -> list[int]:
    """Seats by the highest quotients votes / (2 k + 1), none above its cap; ties go to the earlier one.

    A search for the last quotient that gets a seat gives all seats but a few, so the steps grow with the parties, not the seats.
    """
    caps = caps or [seats] * len(votes)
    seats = min(seats, sum(c for c, v in zip(caps, votes) if v > 0))
    if not seats:
        return [0] * len(votes)

    def above(q: float) -> list[int]:
        """Seats whose quotients are above q."""
        return [min(c, max(0, math.ceil((v / q - 1) / 2))) if v > 0 else 0 for v, c in zip(votes, caps)]

    low, high = 0.0, max(votes)
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        low, high = (mid, high) if sum(above(mid)) > seats else (low, mid)
    out = above(high)
    heap = [(-v / (2 * n + 1), i) for i, (v, c, n) in enumerate(zip(votes, caps, out)) if v > 0 and n < c]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < caps[i]:
            heapq.heappush(heap, (-votes[i] / (2 * out[i] + 1), i))
    return out


def turn_weights(i: int) -> float:
    """The contract's weights: 5, 2, 1, repeating."""
    return (5.0, 2.0, 1.0)[i % 3]


def mix(
    df: DataFrame,
    weight_of: Callable[[int], float] = turn_weights,
    share: float = 1.5,
    repeats: int = 2,
    block: int = 32,
    shard_words: int = 100_000,
    max_shards: int = 65_536,
    max_sources: int = 100_000,
    seed: int = 7,
    passing: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, ``row`` (a struct of the columns ``passing``) and the plan of its shard.

    ``weight_of`` gives a source's weight from its place among the sources by code point, null last. Plan columns: ``at`` (words of
    the shard before the document), ``words``, ``blocks``, ``times``, ``more`` and the permutation's ``mul`` and ``add``.
    """
    spark = df.sparkSession
    count = F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    row = [F.struct(*passing).alias("row")] if passing else []
    sized = keep(df.select("doc_id", "source", count.alias("size"), *row))
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"over {max_sources} sources: raise max_sources, which bounds the driver's table")
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8", "surrogatepass")))
    sizes = [r["size"] for r in rows]
    targets = water_fill([weight_of(i) for i in range(len(rows))], [repeats * s for s in sizes], share * sum(sizes))
    per_shard = max(shard_words, math.ceil(sum(sizes) / max_shards))
    shards = [max(1, math.ceil(s / per_shard)) for s in sizes]
    table = [(r["source"], i, shards[i], sizes[i], float(targets[i])) for i, r in enumerate(rows)]
    of = spark.createDataFrame(table, "src string, sid int, shards int, source_size long, target double")
    dealt = sized.join(F.broadcast(of), F.col("source").eqNullSafe(F.col("src"))).drop("src")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.col("shards")).cast("int"))
    of_shards = dealt.groupBy("sid", "shard").agg(F.sum("size").alias("words")).where("words > 0").collect()
    plans = _quotas(sorted((r["sid"], r["shard"], r["words"]) for r in of_shards), sizes, targets, repeats, block, seed)
    plan = spark.createDataFrame(plans, "sid int, shard int, words long, blocks long, times long, more long, mul long, add long")
    order = Window.partitionBy("sid", "shard").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("at", F.sum("size").over(order) - F.col("size")).join(F.broadcast(plan), ["sid", "shard"], "left")
    first = F.expr("((at + 1) * blocks - 1) div words")
    last = F.expr("((at + size) * blocks - 1) div words")
    extra = F.expr(
        "aggregate(filter(sequence(first, last), i -> (i * mul + add) % blocks < more), 0L, "
        "(s, i) -> s + least(at + size, (i + 1) * words div blocks) - greatest(at, i * words div blocks))"
    )
    taken = F.when((F.col("size") == 0) | F.col("words").isNull(), F.lit(0).cast("long")).otherwise(
        F.col("times") * F.col("size") + F.when(F.col("more") > 0, F.col("extra")).otherwise(F.lit(0))
    )
    some = (F.col("size") > 0) & (F.col("more") > 0)
    out = placed.withColumn("first", F.when(some, first)).withColumn("last", F.when(some, last)).withColumn("extra", extra).withColumn("taken", taken)
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", *(["row"] if passing else []), "at", "words", "blocks", "times", "more", "mul", "add")


def _quotas(shards: list[tuple[int, int, int]], sizes: list[int], targets: list[float], repeats: int, block: int, seed: int) -> list[tuple]:
    """The plan's rows: blocks and quotas of each shard."""
    blocks = [max(1, round(w / block)) for _, _, w in shards]
    of: dict[int, list[int]] = {}
    for k, (sid, _, _) in enumerate(shards):
        of.setdefault(sid, []).append(k)
    sids = sorted(of)
    have = {s: sum(blocks[k] for k in of[s]) for s in sids}
    # A block of a source holds sizes / have words, so targets are votes in blocks.
    votes = [targets[s] * have[s] / sizes[s] for s in sids]
    seats = sainte_lague(votes, round(sum(votes)), [repeats * have[s] for s in sids])
    rng, out = random.Random(seed), []
    for s, n in zip(sids, seats):
        quotas = sainte_lague([float(blocks[k]) for k in of[s]], n, [repeats * blocks[k] for k in of[s]])
        for k, q in zip(of[s], quotas):
            mul = rng.randrange(blocks[k] // 4, blocks[k]) if blocks[k] > 4 else 1
            while math.gcd(mul, blocks[k]) != 1:
                mul = mul % blocks[k] + 1
            out.append((*shards[k], blocks[k], q // blocks[k], q % blocks[k], mul, rng.randrange(blocks[k])))
    return out


_WORD = regex.compile(WORD)


def taken_texts(text: str, at: int, words: int, blocks: int, times: int, more: int, mul: int, add: int) -> list[str]:
    """The document's part in the mix: its whole text ``times`` times, then its blocks that are taken once more."""
    spans = [m.span() for m in _WORD.finditer(text)]
    if not spans:
        return []
    out = [text] * times
    if not more:
        return out
    first, last = ((at + 1) * blocks - 1) // words, ((at + len(spans)) * blocks - 1) // words
    runs: list[list[int]] = []
    for i in range(first, last + 1):
        if (i * mul + add) % blocks < more:
            lo, hi = max(0, i * words // blocks - at), min(len(spans), (i + 1) * words // blocks - at)
            if runs and runs[-1][1] == lo:
                runs[-1][1] = hi
            elif lo < hi:
                runs.append([lo, hi])
    if runs == [[0, len(spans)]]:
        return [*out, text]
    return [*out, "\n".join(text[spans[lo][0] : spans[hi - 1][1]] for lo, hi in runs)] if runs else out


def mixed_documents(df: DataFrame, **settings) -> DataFrame:
    """The mix as documents: a row for each time that a document, or the part of it in taken blocks, is in the mix.

    Returns the columns of ``df``; ``n_chars``, if there, is that of the new text. Documents without words aren't in a mix.
    """
    ship(df.sparkSession)
    cols = df.columns
    plan = ["at", "words", "blocks", "times", "more", "mul", "add"]
    planned = mix(df, passing=tuple(cols), **settings).where("taken > 0")
    rows = planned.select(*(F.col("row")[c].alias(c) for c in cols), F.struct(*plan).alias("__plan"))
    text_at, chars_at = cols.index("text"), cols.index("n_chars") if "n_chars" in cols else -1

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plans = batch.column(len(cols)).to_pylist()
            lists = [taken_texts(t.as_py(), *(p[c] for c in plan)) for t, p in zip(batch.column(text_at), plans)]
            which = pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
            columns = [batch.column(i).take(which) for i in range(len(cols))]
            columns[text_at] = pa.array([x for own in lists for x in own], pa.string())
            if chars_at >= 0:
                columns[chars_at] = pa.array([len(x) for own in lists for x in own], columns[chars_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=cols)

    return rows.mapInArrow(frugal(texts), df.schema)
