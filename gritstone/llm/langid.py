"""Language identification by prediction by partial matching (PPM).

Each language's model is a tree of byte contexts of up to three bytes. A byte that has followed the context is coded at n / (total +
distinct), others escape at distinct / (total + distinct) to the context without its first byte, where the bytes seen before
are excluded, and at last to 256 equal codes. A context of three bytes must have occurred ``LEAST`` times. The statistics are frozen
after training, so the exact code length of a byte after its context is a constant: either that of a byte seen there, or what the
escape costs plus the length in the shorter context. Only what was seen is stored. A text's code length is the sum over its bytes;
the lengths of the distinct four-byte runs of a stretch of text are looked up once. Texts are lower-cased.

Training takes at most ``per_language`` documents of each language, those of the smallest hashes of their ids. Every other step covers
whole texts. A model holds about ``languages`` languages; more of them are dealt to several models by hash, which are held and applied
one after another, with the same result as one model of all.

Null texts and texts without a letter are ``und`` with score 0. Repeated rows get equal results. An empty table gives an empty result;
without any labelled document all is ``und``. Columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritstone.llm._memory import frugal
from gritstone.llm._store import keep
from gritstone.session import ship

#: Bytes of joined texts that are scored at once.
_CHUNK = 1 << 19
#: Code lengths (of a byte by a language) that are laid out at once.
_CELLS = 1 << 22
#: Times that a context of three bytes must occur in training.
LEAST = 3
_PAD = b"\n\n\n"


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte with the three before it as one number, and how often it occurs; texts start after line ends."""
    joined = np.frombuffer(b"".join(_PAD + t.lower().encode("utf-8", "replace") for t in texts), np.uint8).astype(np.uint32)
    if len(joined) < 4:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = joined[:-3] << 24 | joined[1:-2] << 16 | joined[2:-1] << 8 | joined[3:]
    return tuple(x.astype(np.int64) for x in np.unique(grams, return_counts=True))  # type: ignore[return-value]


def _escapes(context: np.ndarray, n: np.ndarray, shorter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits of bytes seen after contexts (sorted), the distinct contexts, and what an escape from each costs beside the shorter one's bits.

    ``shorter`` has the same bytes' bits in the shorter contexts: an escape leaves them out, so what it leaves is scaled up to 1.
    """
    firsts = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(context) else np.zeros(0, np.int64)
    if not len(firsts):
        return np.zeros(0), np.zeros(0, np.int64), np.zeros(0)
    distinct = np.diff(np.r_[firsts, len(context)])
    whole = np.add.reduceat(n, firsts) + distinct
    rest = np.maximum(1 - np.add.reduceat(np.exp2(-shorter), firsts), 1e-9)
    return np.log2(np.repeat(whole, distinct)) - np.log2(n), context[firsts], np.log2(whole * rest / distinct)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, where = np.unique(keys, return_inverse=True)
    return found, np.bincount(where, n, len(found))


def _at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in the sorted ``keys``, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Context:
    """One language's frozen code lengths. Contexts of one byte are laid out whole, longer ones as sorted keys."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, least: int = LEAST):
        grams, n = grams.astype(np.int64), n.astype(np.float64)
        # No context: bytes seen anywhere, else one of 256 equal codes.
        code, own = _summed(grams & 0xFF, n)
        bits, _, cost = _escapes(np.zeros(len(code), np.int64), own, np.full(len(code), 8.0))
        none = np.full(256, 8.0) + (cost[0] if len(cost) else 0.0)
        none[code] = bits
        code, own = _summed(grams & 0xFFFF, n)
        bits, context, cost = _escapes(code >> 8, own, none[code & 0xFF])
        one = np.tile(none, (256, 1))
        one[context] += cost[:, None]
        one.reshape(-1)[code] = bits
        self.one = one.reshape(-1).astype(np.float32)
        code, own = _summed(grams & 0xFFFFFF, n)
        bits, context, cost = _escapes(code >> 8, own, self.one[code & 0xFFFF].astype(float))
        self.two, self.two_bits = code.astype(np.uint32), bits.astype(np.float32)
        self.leave = np.zeros(1 << 16, np.float32)
        self.leave[context] = cost
        self.three, self.three_bits = np.zeros(0, np.uint32), np.zeros(0, np.float32)
        self.often, self.often_cost = np.zeros(0, np.uint32), np.zeros(0, np.float32)
        code, own = _summed(grams, n)
        context, total = _summed(code >> 8, own)
        kept = np.repeat(total >= least, np.unique(code >> 8, return_counts=True)[1])
        code, own = code[kept], own[kept]
        shorter = self.bits(code.astype(np.uint32)).astype(float)
        bits, context, cost = _escapes(code >> 8, own, shorter)
        self.three, self.three_bits = code.astype(np.uint32), bits.astype(np.float32)
        self.often, self.often_cost = context.astype(np.uint32), cost.astype(np.float32)

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """The code length of each run's fourth byte after its first three."""
        out = self.one[grams & 0xFFFF] + self.leave[grams >> 8 & 0xFFFF]
        at, there = _at(self.two, grams & 0xFFFFFF)
        out[there] = self.two_bits[at[there]]
        at, there = _at(self.often, grams >> 8)
        out[there] += self.often_cost[at[there]]
        at, there = _at(self.three, grams)
        out[there] = self.three_bits[at[there]]
        return out


class Ppm:
    """The frozen models of several languages."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], least: int = LEAST):
        self.languages = sorted(counts)
        self.contexts = [Context(*counts[g], least) for g in self.languages]

    def bits(self, grams: np.ndarray) -> np.ndarray:
        return np.stack([c.bits(grams) for c in self.contexts], axis=1)

    def lengths(self, texts: list[str]) -> np.ndarray:
        """Code length in bits of each whole text by each language."""
        out = np.zeros((len(texts), len(self.languages)))
        rows: list[int] = []
        parts: list[bytes] = []
        held = 0
        for i, t in enumerate(texts):
            raw = _PAD + t.lower().encode("utf-8", "replace")
            if len(raw) > 3:
                rows.append(i)
                parts.append(raw)
                held += len(raw)
            if held >= _CHUNK:
                out[rows] = self._sums(parts)
                rows, parts, held = [], [], 0
        if rows:
            out[rows] = self._sums(parts)
        return out

    def _sums(self, parts: list[bytes]) -> np.ndarray:
        ends = np.cumsum([len(p) for p in parts])
        begins = np.r_[0, ends[:-1]]
        s = np.frombuffer(b"".join(parts), np.uint8)
        total = np.zeros((len(parts), len(self.languages)))
        step = min(_CHUNK, max(1, _CELLS // len(self.languages)))
        for lo in range(0, len(s) - 3, step):  # a long text takes several turns
            hi = min(lo + step, len(s) - 3)
            w = s[lo : hi + 3].astype(np.uint32)
            grams, where = np.unique(w[:-3] << 24 | w[1:-2] << 16 | w[2:-1] << 8 | w[3:], return_inverse=True)
            bits = self.bits(grams)[where]  # row j: the byte at lo + j + 3
            # Of each text, its bytes in this stretch; the pads between texts fall out.
            a = np.clip(begins + 3, lo + 3, hi + 3) - lo - 3
            b = np.clip(ends, lo + 3, hi + 3) - lo - 3
            some = np.flatnonzero(b > a)
            if not len(some):
                continue
            cuts = np.stack([a[some], b[some]], axis=1).ravel()
            short = cuts[-1] == len(bits)
            sums = np.add.reduceat(bits, cuts[:-1] if short else cuts, axis=0, dtype=np.float64)
            total[some] += sums[::2]
        return total

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The language of the least code length (ties: the first), that length, and the sum of all languages' chances relative to its own."""
        if not texts:
            return [], np.zeros(0), np.zeros(0)
        bits = self.lengths(texts)
        least = bits.min(axis=1)
        return [self.languages[k] for k in bits.argmin(axis=1)], least, np.exp2(least[:, None] - bits).sum(axis=1)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; null ids: false."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def smallest_hashes(df: DataFrame, key: str, most: int, seed: int, salts: int = 64) -> DataFrame:
    """The ``most`` rows of each key whose ids have the smallest hashes: first of each salted part of a key, then of those."""
    own = df.withColumn("__h", F.xxhash64("doc_id", F.lit(seed))).withColumn("__s", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(salts)))
    for part in ([key, "__s"], [key]):
        own = own.withColumn("__n", F.row_number().over(Window.partitionBy(*part).orderBy("__h", "doc_id"))).where(F.col("__n") <= most)
    return own.drop("__h", "__s", "__n")


class Models:
    """A written table of counts (part, lang, gram, n), from which the models of its ``parts`` are made one at a time."""

    def __init__(self, table: DataFrame, parts: int):
        self.table, self.parts = table, parts

    def load(self, part: int) -> Ppm | None:
        own = self.table.where(F.col("part") == part).select("lang", "gram", "n").toPandas()
        return Ppm({g: (x["gram"].to_numpy(np.int64), x["n"].to_numpy(np.int64)) for g, x in own.groupby("lang")}) if len(own) else None


def train(df: DataFrame, per_language: int = 500, languages: int = 256, seed: int = 11) -> Models | None:
    """The models of the languages named in ``df`` (doc_id, text, lang), which should hold training rows only.

    Executors count the bytes' runs, of at most ``per_language`` documents of each language; the driver makes one part's model at a
    time, of about ``languages`` languages.
    """
    ship(df.sparkSession)
    known = df.where("lang is not null and text is not null")
    chosen = keep(smallest_hashes(known.select("doc_id", "lang"), "lang", per_language, seed).select("doc_id", "lang").distinct())
    found = chosen.select(F.count_distinct("lang").alias("n")).first()["n"]
    if not found:
        return None
    parts = -(-found // languages)
    texts = known.select("doc_id", "lang", "text").join(chosen.withColumnsRenamed({"doc_id": "d", "lang": "g"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("lang") == F.col("g")), "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of: dict[str, list[str]] = {}
            for g, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                of.setdefault(g, []).append(t)
            for g, own in of.items():
                grams, n = gram_counts(own)
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(grams), pa.string()), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"])

    counted = texts.select("lang", "text").mapInArrow(frugal(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    table = keep(counted.withColumn("part", F.pmod(F.xxhash64("lang"), F.lit(parts)).cast("int")))
    return None if table.isEmpty() else Models(table, parts)


def identify(df: DataFrame, models: Models | None, passing: list[str], text: str = "text", out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns ``passing`` with the language and its score, the chance of it by equal priors, named by ``out``."""
    spark = df.sparkSession
    ship(spark)
    # Columns go by number, so that no name of the input can clash. The text is there once, and leaves with the last part's result
    # only if it passes.
    columns = [F.col(c).alias(f"c{i}") for i, c in enumerate(passing)]
    own_text = [] if text in passing else [F.col(text).alias("own")]
    start = [F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"), F.lit("und").alias("lang"), F.lit(float("inf")).alias("least"), F.lit(0.0).alias("chances")]
    rows = df.select(*columns, *start, *own_text)
    n, at = len(passing), passing.index(text) if text in passing else len(passing) + 4

    def step(shared, last: bool) -> DataFrame:
        out = rows.columns[: n + 4] if last else rows.columns

        def better(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            for whole in batches:
                for first in range(0, whole.num_rows, 512):  # few texts at once are Python strings
                    batch = whole.slice(first, 512)
                    which = np.flatnonzero(batch.column(n).to_numpy(zero_copy_only=False))
                    langs = batch.column(n + 1).to_pylist()
                    least, chances = (batch.column(n + k).to_numpy(zero_copy_only=False).copy() for k in (2, 3))
                    found, bits, sums = model.predict([batch.column(at)[int(i)].as_py() for i in which])
                    for i, g, b, s in zip(which, found, bits, sums):
                        if b < least[i] or b == least[i] and g < langs[i]:
                            chances[i] = s + chances[i] * np.exp2(b - least[i]) if chances[i] else s
                            langs[i], least[i] = g, b
                        else:
                            chances[i] += s * np.exp2(least[i] - b)
                    columns = [*batch.columns[: n + 1], pa.array(langs, pa.string()), pa.array(least), pa.array(chances), *([] if last else batch.columns[n + 4 :])]
                    yield pa.RecordBatch.from_arrays(columns, names=out)

        return rows.mapInArrow(frugal(better), rows.select(*out).schema)

    loaded = (models.load(part) for part in range(models.parts)) if models else iter(())
    for part, model in enumerate(loaded):
        if model is not None:
            rows = step(spark.sparkContext.broadcast(model), part + 1 == models.parts)  # type: ignore[union-attr]
            if part + 1 < models.parts:  # type: ignore[union-attr]
                rows = keep(rows)
    score = F.when(F.col("chances") > 0, 1 / F.col("chances")).otherwise(0.0)
    return rows.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(passing)), F.col("lang").alias(out[0]), score.alias(out[1]))
