"""Line dedup through content-defined chunks of lines.

A polynomial rolling hash over the hashes of two lines decides, from these lines alone, whether a chunk ends after the second one; long
lines are chunks of their own. A chunk that stands anywhere else too, in the same document or another, is matched with its first
place, the one in the document of the smallest id. A passage need not hold a whole chunk, so the rolling hash's own windows, every two
neighbouring lines, are matched in the same way; they reach from a chunk's match to the passage's ends. All places of a hash are
compared byte by byte, and hashes that different lines share match nothing.

So the result is defined without hashes: a line is marked if it is long, or stands together with its neighbour, in an earlier place (an
earlier document, or above in the same one). Marked lines make a run as far as each two of its neighbours were found together; runs of at
least ``least_words`` words go. The first place of every line stays.

Rows with the same doc_id and text are one document here: they keep the same lines. Null texts stay null; empty ones stay empty. Null
ids come before others. An empty table gives an empty result. Columns other than doc_id and text pass through unchanged, whatever their
names; one with the name of the count is replaced by it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritstone.llm._memory import frugal
from gritstone.llm._store import drop, keep
from gritstone.session import ship

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: Lines of so many words are chunks of their own.
LONG_LINE = 25


def chunks(lines: list[bytes], seed: int, one_in: int = 2, long_line: int = LONG_LINE) -> list[tuple[int, int]]:
    """Half-open line ranges. An end depends on two neighbouring lines only, wherever they stand."""
    digest = xxhash.xxh64_intdigest
    hashes = [digest(x, seed) for x in lines]
    long = [x.count(b" ") >= long_line - 1 for x in lines]
    out, start = [], 0
    for i in range(1, len(lines)):
        rolled = (hashes[i - 2] * _BASE + hashes[i - 1]) * _BASE & _MASK if i > 1 else hashes[0]
        if long[i] or long[i - 1] or (rolled >> 32) % one_in == 0:
            out.append((start, i))
            start = i
    out.append((start, len(lines)))
    return out


def places(lines: list[bytes], seed: int = 0, long_line: int = LONG_LINE) -> list[tuple[int, int]]:
    """The ranges that are matched: chunks of several lines, long lines, and every two neighbouring lines."""
    out = {(a, b) for a, b in chunks(lines, seed, long_line=long_line) if b - a > 1}
    out.update((i, i + 1) for i, x in enumerate(lines) if x.count(b" ") >= long_line - 1)
    out.update((i, i + 2) for i in range(len(lines) - 1))
    return sorted(out)


def content_hash(content: bytes) -> int:
    """A signed 64-bit hash."""
    h = xxhash.xxh64_intdigest(content, 202)
    return h - (1 << 64) if h >> 63 else h


def _lines(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split(b"\n")


_PLACE = "struct<lo:int,hi:int,h:long>"


def outlines(df: DataFrame, hashed: Callable[[bytes], int] = content_hash) -> DataFrame:
    """doc_id, thash and the places of a text's chunks: (lo, hi, hash)."""
    ship(df.sparkSession)
    rows = df.where("text is not null and text <> ''").select("doc_id", F.xxhash64("text").alias("thash"), "text")
    place = pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("h", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, lo, hi, h = [0], [], [], []
            for text in batch.column(2):
                lines = _lines(text.as_py())
                for a, b in places(lines):
                    lo.append(a)
                    hi.append(b)
                    h.append(hashed(lines[a] if b - a == 1 else b"\n".join(lines[a:b])))
                sizes.append(len(lo))
            flat = pa.StructArray.from_arrays([pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array(h, pa.int64())], fields=list(place))
            own = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), own], names=["doc_id", "thash", "chunks"])

    id_type = df.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(frugal(cut), f"doc_id {id_type}, thash long, chunks array<{_PLACE}>")


def repeats(df: DataFrame, hashed: Callable[[bytes], int] = content_hash) -> DataFrame:
    """doc_id, thash, lo, hi, h and is_first: the places of each hash that has several, and whether this one is the first."""
    own = keep(outlines(df, hashed))
    rows = own.select("doc_id", "thash", F.explode("chunks").alias("c")).select("doc_id", "thash", "c.lo", "c.hi", "c.h")
    place = F.struct("doc_id", "thash", "lo", "hi")
    # A written table, so that Spark can split the rows of a hot chunk when it joins them. Equal rows of a document are one place.
    again = rows.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(~F.col("first").eqNullSafe(F.col("last")))
    again = keep(again.drop("last"))
    return rows.join(again, "h").select("doc_id", "thash", "lo", "hi", "h", place.eqNullSafe(F.col("first")).alias("is_first"))


def _shared(rows: DataFrame) -> DataFrame:
    """Hashes that different bytes share, among the matched places (``places``) of ``text``, by the least and the greatest of each."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple[int, bytes]] = set()
            for text, own in zip(batch.column(0), batch.column(1)):
                lines = _lines(text.as_py())
                found.update((p["h"], b"\n".join(lines[p["lo"] : p["hi"]])) for p in own.as_py())
            hashes, contents = zip(*sorted(found)) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(contents, pa.binary())], names=["h", "content"])

    contents = rows.where("places is not null").select("text", "places").mapInArrow(frugal(spread), "h long, content binary")
    return contents.groupBy("h").agg(F.min("content").alias("a"), F.max("content").alias("b")).where("a <> b").select("h")


def without(text: str, runs: list[tuple[int, int]], least_words: int) -> tuple[str, int]:
    """The text without the runs that are large enough once overlapping ones are joined, and how many lines that removes."""
    lines = text.split("\n")
    joined: list[list[int]] = []
    for lo, hi in sorted(runs):
        if joined and lo < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], hi)
        else:
            joined.append([lo, hi])
    gone: set[int] = set()
    for lo, hi in joined:
        if sum(len(x.split()) for x in lines[lo:hi]) >= least_words:
            gone.update(range(lo, hi))
    return "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)


def dedup_lines(df: DataFrame, least_words: int = 25, count: str = "removed_lines", hashed: Callable[[bytes], int] = content_hash) -> DataFrame:
    """``df`` with repeated runs of lines cut out of ``text``, and their number of lines. ``n_chars``, if there, follows the new text."""
    ship(df.sparkSession)
    cols = df.columns
    found = keep(repeats(df.select("doc_id", "text"), hashed))
    # Columns go by number, so that no name of the input can clash.
    named = df.toDF(*(f"c{i}" for i in range(len(cols))))
    id_at, text_at, chars_at = (cols.index(c) if c in cols else -1 for c in ("doc_id", "text", "n_chars"))

    def beside(matched: DataFrame) -> DataFrame:
        """The rows with the matched places of their text, a list that no more than a document's lines bound."""
        lists = matched.groupBy(F.col("doc_id").alias("d"), F.col("thash").alias("t")).agg(F.collect_set(F.struct("lo", "hi", "h", "is_first")).alias("places"))
        same = F.col(f"c{id_at}").eqNullSafe(F.col("d")) & (F.xxhash64(f"c{text_at}") == F.col("t"))
        return keep(named.join(lists, same, "left").drop("d", "t"))

    rows = beside(found)
    bad = keep(_shared(rows.select(F.col(f"c{text_at}").alias("text"), "places")))
    if not bad.isEmpty():
        drop(rows)
        rows = beside(found.join(bad, "h", "left_anti"))
    left = [i for i, c in enumerate(cols) if c != count]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(len(cols))]
            texts, chars = columns[text_at].to_pylist(), columns[chars_at].to_pylist() if chars_at >= 0 else []
            removed = [0] * len(texts)
            for i, own in enumerate(batch.column(len(cols))):
                if own.is_valid and texts[i]:
                    spans = [(p["lo"], p["hi"]) for p in own.as_py() if not p["is_first"]]
                    texts[i], removed[i] = without(texts[i], spans, least_words)
                    if chars_at >= 0 and removed[i]:
                        chars[i] = len(texts[i])
            columns[text_at] = pa.array(texts, pa.string())
            if chars_at >= 0:
                columns[chars_at] = pa.array(chars, columns[chars_at].type)
            yield pa.RecordBatch.from_arrays([*(columns[i] for i in left), pa.array(removed, pa.int64())], names=[*(cols[i] for i in left), count])

    return rows.mapInArrow(frugal(cut), df.select(*(df[cols[i]] for i in left), F.lit(0).cast("long").alias(count)).schema)
