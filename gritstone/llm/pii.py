"""Personal data by patterns of form and by bootstrapped context.

Four kinds have forms that are found in every whole text (the base spans). They are the first instances of a second search: the words
around an instance make lexical patterns (two words before, one before, one before with one after), and other tokens that look like
identifiers, with a digit or an @, are unseen candidates; tokens of digits that a space, hyphen or bracket parts are one candidate.
Patterns and values form a graph that Spark scores in turns. A pattern's confidence in a kind is the share of its values' scores of
that kind; patterns of high confidence that enough distinct instances support are kept. A candidate in their places, whose form may be
of that kind, gets what they leave no doubt about as its score (noisy-or) and is an instance from then on: the other contexts it stands
in support new patterns, which the next turn finds more candidates by. In the end all places of confident patterns give the added
spans. Base spans always stay.

Null texts count as empty and have no spans. Rows of the same doc_id and text are one document here and get equal results. An empty table
gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritstone.llm._store import keep
from gritstone.session import ship

KINDS = ("email", "ip", "card", "phone")

# The forms, so written that no text makes a search go back: a run that fails where it starts also fails from within.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER = re.compile(r"[0-9]+")
_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_TOKEN = re.compile(r"\S+")
#: A part of a number, and what may stand between two parts of one.
_DIGITS = re.compile(r"[0-9+][0-9().+/-]*")
_JOINT = re.compile(r"[)]?[ -]?[(]?")
_EDGE = "\"'`.,;:!?()[]{}<>*#$%&=|/\\"


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, after = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > after and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append((start, m.end()))
                after = m.end()
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of each span of a form, by kind and start."""
    out = [(0, *s) for s in _emails(text)]
    if not _NUMBER.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = "".join(_NUMBER.findall(m.group()))
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(len, _NUMBER.findall(m.group()))) <= 15:
                out.append((3, *m.span()))
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Tokens that have a digit or an @ and don't touch a base span, without marks around them; parts of one number are joined."""
    out: list[tuple[int, int]] = []
    number, at = False, 0  # whether the last one found is a number
    spans = sorted((s, e) for _, s, e in base)
    k = 0
    while m := _MARK.search(text, at):
        left = m.start()
        while left > at and not text[left - 1].isspace():
            left -= 1
        end = _SPACE.search(text, m.start())
        right = end.start() if end else len(text)
        at = right
        a, b = left, right
        while a < b and text[a] in _EDGE:
            a += 1
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        while k < len(spans) and spans[k][1] <= a:
            k += 1
        if a < b and not (k < len(spans) and spans[k][0] < b):
            digits = _DIGITS.fullmatch(text, a, b) is not None
            if digits and number and a - out[-1][1] <= 3 and _JOINT.fullmatch(text, out[-1][1], a):
                out[-1] = (out[-1][0], b)
            else:
                out.append((a, b))
            number = digits
    return out


def _short(value: str, most: int = 64) -> str:
    """The value, or a digest of a long one."""
    return value if len(value) <= most else f"{value[:16]}#{xxhash.xxh3_128_hexdigest(value.encode('utf-8', 'surrogatepass'))}"


def _word(token: str) -> str:
    return _short(token.strip(_EDGE).lower())


class Words:
    """The white-space tokens of a text, and the patterns around its spans."""

    def __init__(self, text: str):
        self.text = text
        places = [m.span() for m in _TOKEN.finditer(text)]
        self.starts, self.ends = [a for a, _ in places], [b for _, b in places]

    def contexts(self, start: int, end: int) -> list[str]:
        """The lexical patterns around a span: two words before, one before, one before with one after."""
        i, j = bisect_left(self.starts, start), bisect_right(self.ends, end)
        # Marks that touch the span are no words.
        if i and self.ends[i - 1] > start and not _word(self.text[self.starts[i - 1] : start]):
            i -= 1
        if j < len(self.ends) and self.starts[j] < end and not _word(self.text[end : self.ends[j]]):
            j += 1
        before = [_word(self.text[self.starts[k] : min(self.ends[k], start)]) for k in range(max(0, i - 2), i)]
        after = [_word(self.text[max(self.starts[k], end) : self.ends[k]]) for k in range(j, min(j + 1, len(self.ends)))]
        out = []
        if before:
            out.append("1|" + before[-1])
            if after:
                out.append("3|" + before[-1] + "|" + after[0])
        if len(before) == 2:
            out.append("2|" + " ".join(before))
        return [p for p in out if p[2:].strip(" |")]


def may_be(kind: int, value: str) -> bool:
    """Whether a candidate's form allows the kind, more loosely than the kind's own form."""
    digits = sum(c.isdigit() for c in value)
    if kind == 0:
        return "@" in value[1:-1]
    if kind == 1:
        return value.count(".") == 3 and digits >= 4 or value.count(":") >= 2 and digits >= 1
    letters = any(c.isalpha() for c in value)
    return not letters and (12 <= digits <= 19 if kind == 2 else 7 <= digits <= 15)


_SPAN = "struct<kind:int,start:int,end:int>"
_FOUND = "struct<kind:int,start:int,end:int,value:string,patterns:array<string>,may:array<int>>"


def spans_and_contexts(df: DataFrame) -> DataFrame:
    """doc_id, thash, base (spans) and found (base spans of kind 0 to 3 and candidates of kind -1, each with its value and patterns)."""
    ship(df.sparkSession)
    rows = df.select("doc_id", F.xxhash64("text").alias("thash"), "text")
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    found = pa.struct([*span, ("value", pa.string()), ("patterns", pa.list_(pa.string())), ("may", pa.list_(pa.int32()))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, more = [], []
            for t in batch.column(2):
                text = t.as_py() or ""
                own = base_spans(text)
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in own])
                all_ = [*own, *((-1, s, e) for s, e in candidates(text, own))]
                words = Words(text) if all_ else None
                more.append(
                    [
                        {"kind": k, "start": s, "end": e, "value": _short(text[s:e].lower()), "patterns": words.contexts(s, e), "may": [] if k >= 0 else [j for j in range(4) if may_be(j, text[s:e])]}
                        for k, s, e in all_
                    ]
                )
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(base, pa.list_(span)), pa.array(more, pa.list_(found))], names=["doc_id", "thash", "base", "found"])

    id_type = df.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(search, f"doc_id {id_type}, thash long, base array<{_SPAN}>, found array<{_FOUND}>")


def confident_patterns(found: DataFrame, turns: int = 3, confidence: float = 0.8, support: int = 5) -> DataFrame:
    """pattern, kind and turn of the patterns that are confident of a kind and supported by so many distinct instances of it.

    The graph is a written table of distinct edges. A turn joins it with the instances, sums by pattern, and joins it with the confident
    patterns to score candidates. Scores only grow, so a pattern once confident stays so.
    """
    each = found.select(F.explode("f.patterns").alias("pattern"), "f.value", "f.kind", "f.may")
    edges = keep(each.groupBy("pattern", "value", "kind").agg(F.max("may").alias("may")))
    totals = keep(edges.groupBy("pattern").agg(F.count("*").alias("total")).where(F.col("total") >= support))
    kinds = [F.when(F.col("kind") == k, 1.0).otherwise(0.0).alias(f"s{k}") for k in range(4)]
    seeds = edges.where("kind >= 0").select("value", "kind").distinct().select("value", "kind", *kinds)
    instances = keep(seeds)
    good = None
    for turn in range(1, turns + 1):
        shares = [(F.sum(f"s{k}") / (F.first("total") + 1.0)).alias(f"p{k}") for k in range(4)]
        numbers = [F.count(F.when(F.col(f"s{k}") >= 0.5, 1)).alias(f"n{k}") for k in range(4)]
        sums = edges.join(instances, ["value", "kind"]).join(totals, "pattern").groupBy("pattern").agg(*shares, *numbers)
        pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"p{k}").alias("p"), F.col(f"n{k}").alias("n")) for k in range(4))))
        sure = sums.select("pattern", pairs.alias("x")).where((F.col("x.p") >= confidence) & (F.col("x.n") >= support))
        sure = sure.select("pattern", F.col("x.kind").alias("k"), F.col("x.p").alias("p"), F.lit(turn).alias("turn"))
        if good is not None:
            old = good.select("pattern", "k", F.col("turn").alias("since"))
            sure = sure.join(old, ["pattern", "k"], "left").select("pattern", "k", "p", F.coalesce("since", "turn").alias("turn"))
        last, good = good, keep(sure)
        if turn == turns or last is not None and last.count() == good.count():
            break
        doubt = lambda k: F.sum(F.when(F.col("k") == k, F.log(1 - F.col("p"))).otherwise(0.0))
        scores = edges.where("kind < 0").join(good, "pattern").where(F.array_contains("may", F.col("k"))).groupBy("value", "kind").agg(*((1 - F.exp(doubt(k))).alias(f"s{k}") for k in range(4)))
        instances = keep(seeds.unionByName(scores))
    assert good is not None
    return good.select("pattern", F.col("k").alias("kind"), "turn")


def personal_data(df: DataFrame, turns: int = 3, confidence: float = 0.8, support: int = 5) -> DataFrame:
    """doc_id, base and added: arrays of (kind, start, end), each sorted; added are the spans that context finds."""
    rows = keep(spans_and_contexts(df))
    each = rows.select("doc_id", "thash", F.explode("found").alias("f"))
    good = confident_patterns(each, turns, confidence, support)
    places = each.where("f.kind < 0 and size(f.may) > 0").select("doc_id", "thash", "f.start", "f.end", "f.may", F.explode("f.patterns").alias("pattern"))
    hits = places.join(good, "pattern").where(F.array_contains("may", F.col("kind")))
    one = hits.groupBy("doc_id", "thash", "start", "end").agg(F.min("kind").alias("kind"))
    lists = one.groupBy("doc_id", "thash").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    lists = lists.select(F.col("doc_id").alias("d"), F.col("thash").alias("t"), "added")
    out = rows.select("doc_id", "thash", "base").join(lists, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("thash") == F.col("t")), "left")
    return out.select("doc_id", "base", F.coalesce("added", F.array().cast(f"array<{_SPAN}>")).alias("added"))


def spans_text(spans):
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat(F.get(names, s["kind"]), F.lit(":"), s["start"], F.lit(":"), s["end"])), ",")
