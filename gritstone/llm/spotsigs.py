"""Document fingerprints of spot signatures, in DataFrame functions only.

A spot signature is a common word (an anchor) with the chain of the next ``chain`` content words within ``reach`` words after it. A
document's fingerprint is the set of its signatures' hashes. A text without any signature has the hash of all its words as its only
one, so different texts of that kind differ. Two fingerprints are compared by Jaccard similarity; the sizes of the sets bound it, so
pairs of too different sizes aren't compared, and documents are only matched within neighbouring length classes.

Null texts count as empty; empty texts are alike. Equal texts have equal fingerprints. The next document is that of the next higher
doc_id (rows of one id: by a hash of their texts, null ids first); the last one's next is the first, a single one's is itself. An empty
table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gritstone.llm._store import keep

# Common words of English, French, German and Spanish, which serve as anchors.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his in is it its not of on or she that the their they this to was were which will with you "
    "au aux avec ce ces dans de des du elle en est et il je la le les leur lui mais ne nous ou par pas plus pour que qui sa se ses son sur un une vous "
    "als am auch auf aus bei das dem den der des die ein eine er es hat ich im ist mit nach nicht sich sie sind so und von war werden wie wird zu zum "
    "al como con del el ella era esta este lo los las muy no o para pero por porque ser si sin sobre su sus también todo una y ya"
).split()

_FAR_LEFT = -(2**63)


def signatures(text: Column, chain: int = 2, reach: int = 6) -> Column:
    """The sorted distinct hashes of a text's spot signatures."""
    anchors = sorted(set(ANCHORS))
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def spots(w: Column) -> Column:
        """Of each anchor, itself with its chain; w is bound once, so the text is split once."""
        chains = F.transform(
            w,
            lambda x, i: F.when(
                x.isin(anchors), F.concat(F.array(x), F.slice(F.filter(F.slice(w, i + 2, reach), lambda y: ~y.isin(anchors)), 1, chain))
            ),
        )
        hashes = F.transform(F.filter(chains, lambda c: F.size(c) > 1), lambda c: F.xxhash64(c))
        return F.when(F.size(hashes) > 0, hashes).otherwise(F.array(F.xxhash64(w)))

    found = F.transform(F.array(words), spots)[0]
    # Bound once more: the result is used twice.
    return F.sort_array(F.array_distinct(found))


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 0 without comparing them where their sizes keep it below ``at_least``."""
    common = F.size(F.array_intersect(a, b))
    jaccard = common / (F.size(a) + F.size(b) - common)
    if at_least <= 0:
        return jaccard
    return F.when(F.least(F.size(a), F.size(b)) >= at_least * F.greatest(F.size(a), F.size(b)), jaccard).otherwise(F.lit(0.0))


def as_text(signatures: Column) -> Column:
    """A fingerprint as a string: its hashes in hexadecimal, with points between."""
    return F.array_join(F.transform(signatures, lambda h: F.hex(h)), ".")


def _ranges(df: DataFrame, bucket_chars: int, most: int) -> tuple[DataFrame, int]:
    """Rows with ``k`` (the id, null first), ``h`` (breaks ties) and ``bucket``, which ascends with the id, and how many buckets there may be."""
    rows = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(_FAR_LEFT)).alias("k"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    n = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    wanted = max(1, min(most, math.ceil(n / bucket_chars)))
    cuts: list[float] = []
    if wanted > 1:
        at = rows.agg(F.percentile_approx("k", [i / wanted for i in range(1, wanted)], max(10_000, 4 * wanted)).alias("q")).first()["q"]
        cuts = sorted({float(x) for x in at})
    splits = [-math.inf, *cuts, math.inf]
    if len(splits) < 3:
        return rows.withColumn("bucket", F.lit(0)), 1
    cut = Bucketizer(splits=splits, inputCol="kd", outputCol="b")
    placed = cut.transform(rows.withColumn("kd", F.col("k").cast("double"))).withColumn("bucket", F.col("b").cast("int"))
    return placed.drop("kd", "b"), len(splits) - 1


def with_next(df: DataFrame, bucket_chars: int = 4 << 20, most_buckets: int = 65_536) -> DataFrame:
    """doc_id, text, the next document's text, and the columns that order them (bucket, guest, k, h).

    Documents are dealt to ranges of ids of about ``bucket_chars`` bytes. Each range also gets a guest, the next range's first
    document, so that no row needs to see beyond its range; drop guests (``guest`` is 1) in the end.
    """
    rows, _ = _ranges(df, bucket_chars, most_buckets)
    firsts = rows.groupBy("bucket").agg(F.min("k").alias("k")).collect()  # most_buckets rows at most
    firsts.sort(key=lambda r: r["bucket"])
    pairs = [(firsts[(i + 1) % len(firsts)]["k"], firsts[i]["bucket"]) for i in range(len(firsts))]
    rows = rows.withColumn("guest", F.lit(0))
    if not pairs:
        return rows.withColumn("next_text", F.lit(""))
    hosts = df.sparkSession.createDataFrame(pairs, "k long, host int")  # most_buckets rows at most
    seen = rows.join(F.broadcast(hosts), "k")
    first = seen.groupBy("host", "k").agg(F.min_by(F.struct("doc_id", "text", "h"), F.col("h")).alias("r"))
    guests = first.select("r.doc_id", "r.text", "k", "r.h", F.col("host").alias("bucket"), F.lit(1).alias("guest"))
    both = rows.unionByName(guests)
    return both.withColumn("next_text", F.lead("text").over(Window.partitionBy("bucket").orderBy("guest", "k", "h")))


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last half (rounded down) replaced by as many first characters of the next document."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(next_text, F.lit(1), half))


def compare_neighbours(df: DataFrame) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document."""
    placed = with_next(df)
    changed = placed.select("doc_id", "text", "bucket", "guest", "k", "h", F.coalesce(edited(F.col("text"), F.col("next_text")), F.lit("")).alias("edited"))
    prints = changed.select(
        "doc_id", "bucket", "guest", "k", "h", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        signatures(F.col("text")).alias("own"), signatures(F.col("edited")).alias("other"),
    )
    ahead = prints.withColumn("ahead", F.lead("own").over(Window.partitionBy("bucket").orderBy("guest", "k", "h"))).where("guest = 0")
    return ahead.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("ahead")).alias("near_next"),
    )


def similar(df: DataFrame, at_least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Classes and pairs: (doc_id, class_id, n) with the smallest doc_id of equal fingerprints, and (a, b, jaccard) between classes.

    Sets of a similarity of ``at_least`` are in the same length class or neighbouring ones (classes grow by 1 / at_least), and share one
    of the rarest signatures of either, those that are left when at_least * size of the most frequent ones are put aside. Pairs are joined
    by class and such a signature, and their sets compared exactly. All of ``df`` takes part; nothing is capped.
    """
    sets = df.select("doc_id", signatures(F.col("text")).alias("s"))
    members = keep(sets.withColumn("c", F.xxhash64("s")).select("doc_id", "c", "s"))
    classes = keep(members.groupBy("c").agg(F.min("doc_id").alias("class_id"), F.first("s").alias("s"), F.count("*").alias("n")))
    counts = classes.select(F.explode("s").alias("h")).groupBy("h").count()
    each = classes.select("class_id", F.explode("s").alias("h"), F.size("s").alias("size")).join(counts, "h")
    rank = F.row_number().over(Window.partitionBy("class_id").orderBy("count", "h"))
    prefix = each.withColumn("rank", rank).where(F.col("rank") <= F.col("size") - F.ceil(F.col("size") * at_least) + 1)
    length = F.floor(F.log(F.col("size").cast("double")) / math.log(1 / at_least)).cast("int")
    prefix = keep(prefix.select("class_id", "h", "size", length.alias("length")))
    a = prefix.select(F.col("class_id").alias("a"), "h", F.col("size").alias("na"), F.explode(F.array("length", F.col("length") + 1)).alias("length"))
    b = prefix.select(F.col("class_id").alias("b"), "h", F.col("size").alias("nb"), F.explode(F.array("length", F.col("length") + 1)).alias("length"))
    near = (F.col("a") < F.col("b")) & (F.least("na", "nb") >= at_least * F.greatest("na", "nb"))
    pairs = a.join(b, ["h", "length"]).where(near).select("a", "b").distinct()
    sa, sb = (classes.select(F.col("class_id").alias(x), F.col("s").alias(f"s{x}")) for x in "ab")
    found = pairs.join(sa, "a").join(sb, "b").withColumn("jaccard", likeness(F.col("sa"), F.col("sb"), at_least)).where(F.col("jaccard") >= at_least)
    return members.join(classes.select("c", "class_id", "n"), "c").select("doc_id", "class_id", "n"), found.select("a", "b", "jaccard")
