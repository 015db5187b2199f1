"""Best-two-fit packing of token sequences into fixed lengths.

Documents are cut into pieces of at most ``size`` tokens; full pieces fill a sequence each, under any unused number. The others are packed by best-two-fit: a
bin is filled greedily with the longest pieces that still fit, then its smallest piece is replaced by the two unpacked pieces that fill
the widened gap best, where they fill it better. Lengths are all that matters for this, so it runs on the counts of each length (at
most ``size`` numbers, whatever the data's size) and gives patterns with multiplicities: a bin's decisions repeat until a length of it
runs out. A piece gets its rank among those of its length, by two-level counting over salted parts of each length, and the rank gives
its pattern, sequence and offset by a lookup in a table that grows with ``size`` only.

A null or empty text is one piece with the end token alone. Repeated rows are documents of their own. An empty table gives an empty
result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gritstone.llm._memory import frugal
from gritstone.llm._store import keep
from gritstone.session import ship

#: The string that the tokenizer file names as a special token.
SPECIAL = "<|endoftext|>"


#: Parts that a worker's encoder knows between tasks.
RESTING = 100_000


class Encoder:
    """Ids as little-endian 32-bit bytes, the same ids as the ``tokenizers`` library gives for the file ``<name>.json``.

    A space between two characters that aren't white space always begins a new pre-token, so texts are cut there and the ids of each
    part are kept in a bounded table; a large one does not outlive its task. Texts with special strings go through the library itself.
    """

    def __init__(self, name: str = "byte_bpe_50k", most: int = 1_000_000):
        import public_tokenizers
        import tiktoken

        self.name, self.most, self.known = name, most, {}
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.whole = None

    def library(self, text: str) -> bytes:
        if self.whole is None:
            import public_tokenizers
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(public_tokenizers.path(f"{self.name}.json"))
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            return self.library(text)
        parts = text.split(" ")
        if any(not p or p[0].isspace() or p[-1].isspace() for p in parts):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        known, out = self.known, []
        if len(known) > self.most:
            known.clear()
        first = True
        for p in parts:
            # The first part has no space before it: its key has a mark that no later part can have.
            key = p if not first else "\n" + p
            ids = known.get(key)
            if ids is None:
                ids = known[key] = np.array(self.fast.encode_ordinary(p if first else " " + p), "<u4").tobytes()
            out.append(ids)
            first = False
        return b"".join(out)

    def rest(self) -> None:
        """Between tasks a large table of parts goes: the worker lives on, and other stages run beside it."""
        if len(self.known) > RESTING:
            self.known = {}


_ENCODER: list[Encoder] = []


def encoder() -> Encoder:
    """One for each Python worker."""
    if not _ENCODER:
        _ENCODER.append(Encoder())
    return _ENCODER[0]


def pieces(df: DataFrame, size: int = 1024, end: int = 2, make: Callable[[], Callable[[str], bytes]] = encoder) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each piece; a document's first piece is the one that may be shorter."""
    ship(df.sparkSession)
    rows = df.select("doc_id", "text")
    tail = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make()
        for batch in batches:
            which, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "") + tail
                n, at, k = len(ids) // 4, 0, 0
                while at < n:
                    upto = min(n, (n - 1) % size + 1 if at == 0 else at + size)
                    which.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(upto - at)
                    crc.append(zlib.crc32(ids[4 * at : 4 * upto]))
                    at, k = upto, k + 1
            columns = [batch.column(0).take(pa.array(which, pa.int64())), *(pa.array(x, t) for x, t in zip((piece, start, length, crc), (pa.int32(), pa.int64(), pa.int64(), pa.int64())))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])
        if isinstance(encode, Encoder):
            encode.rest()

    schema = rows.select("doc_id", *(F.lit(0).cast(t).alias(c) for c, t in (("piece", "int"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")))).schema
    return rows.mapInArrow(frugal(cut), schema)


def best_two_fit(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of a bin) and how many bins have them, from the number of pieces of each length (below ``size``)."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)
    out: list[tuple[tuple[int, ...], int]] = []

    def gone() -> None:
        nonlocal lengths
        if any(not left[n] for n in lengths):
            lengths = [n for n in lengths if left[n]]

    while lengths:
        # One bin: `used` holds what it takes of each length.
        used: dict[int, int] = {}
        gap = size

        def free(n: int) -> int:
            return left[n] - used.get(n, 0)

        i = len(lengths) - 1
        while gap and i >= 0:
            i = min(i, bisect.bisect_right(lengths, gap) - 1)
            while i >= 0 and not free(lengths[i]):
                i -= 1
            if i < 0:
                break
            n = lengths[i]
            take = min(gap // n, free(n))
            used[n] = used.get(n, 0) + take
            gap -= take * n
        if gap and sum(used.values()) > 1:
            small = min(used)
            room, best = gap + small, (small, None)
            lo, hi = 0, bisect.bisect_right(lengths, room) - 1
            while lo <= hi:
                a, b = lengths[lo], lengths[hi]
                if not free(a) or (lo == hi and free(a) < 2) and a + b <= room:
                    lo += 1
                elif not free(b):
                    hi -= 1
                elif a + b > room:
                    hi -= 1
                else:
                    if a + b > best[0]:
                        best = (a + b, (a, b))
                    lo += 1
            if best[1]:
                used[small] -= 1
                for n in best[1]:
                    used[n] = used.get(n, 0) + 1
        used = {n: k for n, k in used.items() if k}
        times = min(left[n] // k for n, k in used.items())
        out.append((tuple(n for n in sorted(used, reverse=True) for _ in range(used[n])), times))
        for n, k in used.items():
            left[n] -= times * k
        gone()
    return out


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, rank after the last, sequence of the first, offset): where ranks of a length go."""
    at: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for n in pattern:
            rank = at.get(n, 0)
            out.append((n, rank, rank + times, sequence, offset))
            at[n] = rank + times
            offset += n
        sequence += times
    return out


def pack(cut: DataFrame, size: int = 1024, part_rows: int = 100_000) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. ``cut`` must be a written table: it is read several times.

    Full pieces need no place among others: each gets a number of its own. The others are ranked in salted parts of about ``part_rows``.
    """
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one row a length
    full = counts.pop(size, 0)
    patterns = best_two_fit(counts, size)
    table = slots(patterns)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    salts = max(8, -(-max(counts.values(), default=0) // part_rows))
    salted = cut.where(F.col("length") < size).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    parts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    places = spark.createDataFrame(table, "n long, lo long, hi long, first long, offset long")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("in_part", F.row_number().over(within) - 1)
    # Both sides are dealt by length and salt already, so this join moves the counts only.
    ranked = ranked.join(starts, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("in_part"))
    # A few rows for each length, whatever the data's size.
    found = ranked.join(F.broadcast(places), (F.col("length") == F.col("n")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    out = found.select(*names, (F.col("first") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset")
    if not full:
        return out
    alone = cut.where(F.col("length") == size)
    number = F.monotonically_increasing_id() + F.lit(sum(n for _, n in patterns))
    return out.unionByName(alone.select(*names, number.alias("sequence_id"), F.lit(0).cast("long").alias("offset")))


def packed(df: DataFrame, size: int = 1024, end: int = 2) -> DataFrame:
    """All documents, cut and packed."""
    return pack(keep(pieces(df, size, end)), size)
