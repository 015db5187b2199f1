"""Each operator against brute force, an exact round trip or held-out accuracy, and on odd rows and empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gritstone.llm import langid, linededup, mixing, packing, pii, queries, simhash, spotsigs, tokencount, toxicity, vptree
from gritstone.llm._components import components

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


# 1 mixing


def highest_quotients(votes, seats, caps):
    out = [0] * len(votes)
    for _ in range(seats):
        best = max((i for i in range(len(votes)) if votes[i] > 0 and out[i] < caps[i]), key=lambda i: (votes[i] / (2 * out[i] + 1), -i), default=None)
        if best is None:
            break
        out[best] += 1
    return out


def test_sainte_lague_equals_the_quotients():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randrange(1, 7)
        votes = [float(rng.randrange(0, 50)) for _ in range(n)]
        caps = [rng.randrange(1, 12) for _ in range(n)]
        seats = rng.randrange(0, 30)
        assert mixing.sainte_lague(votes, seats, caps) == highest_quotients(votes, seats, caps), (votes, seats, caps)


def test_water_fill():
    assert mixing.water_fill([5, 2, 1], [100, 100, 100], 80) == [50, 20, 10]
    got = mixing.water_fill([5, 2, 1], [10, 100, 100], 80)
    assert got[0] == 10 and abs(got[1] - 140 / 3) < 1e-9 and abs(got[2] - 70 / 3) < 1e-9


def test_mix(spark, docs, texts):
    rows = queries.op1_mixing(spark, DIR).collect()
    again = queries.op1_mixing(spark, DIR).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sums: dict[str, list] = {}
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]])) and 0 <= r["taken"] <= 2 * r["size"]
        s = sums.setdefault(source[r["doc_id"]], [0, r["target"], 0])
        s[0] += r["taken"]
        s[2] += r["size"]
    assert all(abs(t - target) <= max(40, 0.02 * target) for t, target, _ in sums.values())
    assert abs(sum(s[1] for s in sums.values()) - 1.5 * sum(s[2] for s in sums.values())) < 1


def test_mixed_texts_have_the_words_taken(docs):
    plan = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    words: dict[int, int] = {}
    for r in mixing.mixed_documents(docs).collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert words == {k: v for k, v in plan.items() if v}


def test_mix_odd(odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and all(r["taken"] == 0 for r in rows if not r["size"])
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns and all(r["text"] for r in out.collect())
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


# 2 toxicity


def test_network_gradients():
    rng = np.random.default_rng(0)
    net, voc = toxicity.Network(), toxicity.Vocabulary()
    voc.ids("some bad words here now and then")
    for k in toxicity.Network.NAMES:
        setattr(net, k, getattr(net, k).astype(np.float64))
    flat = voc.flat(range(len(voc.slots)))
    ids, mask, y = rng.integers(0, len(voc.slots), (3, toxicity.LENGTH)), np.zeros((toxicity.LENGTH, 3)), np.array([1.0, 0, 1])
    mask[40:, 1] = -1e9

    def loss():
        z = net.logits(net.project(net.embed(*flat)), ids, mask)
        return (np.logaddexp(0, z) - y * z).mean()

    g = net.gradients(*flat, ids, mask, y)
    for k in toxicity.Network.NAMES:
        a = getattr(net, k)
        i = np.unravel_index(np.abs(g[k]).argmax(), a.shape)
        old = a[i]
        a[i] = old + 1e-4
        up = loss()
        a[i] = old - 1e-4
        down = loss()
        a[i] = old
        assert np.isclose(g[k][i], (up - down) / 2e-4, rtol=1e-3), k


def test_windows_cover_all_words():
    counts = np.array([0, 1, 23, 24, 47, 48, 49, 72, 73, 500])
    starts, ends, of = toxicity.windows(counts)
    begins = np.r_[0, np.cumsum(counts)[:-1]]
    for t, n in enumerate(counts):
        seen = {x for s, e, o in zip(starts, ends, of) if o == t for x in range(s - begins[t], e - begins[t])}
        assert seen == set(range(n))


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = [r for r in queries.op2_toxicity(spark, d).collect()]
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) / len(held) > 0.95
    toxic = [r for r in held if labels[r["doc_id"]]]
    assert sum(r["predicted"] for r in toxic) / len(toxic) > 0.75


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (5, 0), (7, 0), (10, 1), (None, 1), (9, None)], "doc_id long, toxic int")
    scorer = toxicity.train(odd, labels)
    rows = toxicity.score(odd, scorer, ["doc_id"]).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.train(odd, labels.limit(0)) is None and toxicity.train(empty, labels) is None
    assert [r["score"] for r in toxicity.score(odd, None, ["doc_id"]).collect()] == [0.0] * odd.count()
    assert toxicity.score(empty, scorer, ["doc_id"]).count() == 0


# 3 packing


def test_packing_round_trip(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {k: library.encode(t, add_special_tokens=False).ids + [2] for k, t in texts.items()}
    rows = queries.op3_packing(spark, DIR).collect()
    parts: dict[int, int] = {}
    sequences: dict[int, list] = {}
    for r in rows:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == r["ids_crc32"]
        parts[r["doc_id"]] = parts.get(r["doc_id"], 0) + r["length"]
        assert r["piece"] == 0 or r["length"] == 1024
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert parts == {k: len(v) for k, v in ids.items()}
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    least = -(-sum(parts.values()) // 1024)
    assert len(sequences) <= least * 1.05 + 1


def test_encoder_equals_the_library():
    enc = packing.Encoder()
    rng = random.Random(2)
    parts = ["the", " ", "  ", "\n", "\t", "don't", "I'll", "é", "日本", "123", "!!", " ", "　", "word", "<|endoftext|>", "😀", "x" * 50, ".\n", "'s", "_", "​"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert enc(t) == enc.library(t), repr(t)


def test_a_large_table_of_parts_does_not_outlive_its_task(spark):
    """A worker lives on beside the next stages, and so did up to a million parts, over 100 MB."""
    docs = spark.range(8).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 20000), x -> concat('w', id * 20000 + x))) as text").coalesce(1)
    assert packing.pieces(docs).agg(F.sum("length")).first()[0] > 100_000

    def known(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(e.known) for e in packing._ENCODER], pa.int64())], names=["n"])

    left = spark.range(64).repartition(64).mapInArrow(known, "n long").toPandas()["n"]
    assert len(left) and left.max() <= 100_000


def plain_best_two_fit(counts, size):
    """Bins, one piece after another: fill greedily, then try every two unpacked pieces in place of the smallest."""
    left = sorted((n for n, c in counts.items() for _ in range(c)), reverse=True)
    bins = 0
    while left:
        own, gap = [], size
        for n in list(left):
            if n <= gap:
                own.append(n)
                left.remove(n)
                gap -= n
        if gap and len(own) > 1:
            room = gap + min(own)
            pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1 :] if min(own) < a + b <= room]
            if pairs:
                _, a, b = max(pairs)
                left.remove(a)
                left.remove(b)
                left.append(min(own))
                left.sort(reverse=True)
        bins += 1
    return bins


def test_best_two_fit():
    rng = random.Random(3)
    for _ in range(100):
        size = rng.randrange(5, 60)
        counts = {rng.randrange(1, size): rng.randrange(1, 30) for _ in range(rng.randrange(0, 12))}
        patterns = packing.best_two_fit(counts, size)
        used: dict[int, int] = {}
        for pattern, times in patterns:
            assert sum(pattern) <= size and times > 0
            for n in pattern:
                used[n] = used.get(n, 0) + times
        assert used == counts
    for _ in range(60):
        size = rng.randrange(5, 40)
        counts = {rng.randrange(1, size): rng.randrange(1, 4) for _ in range(rng.randrange(1, 10))}
        got = sum(n for _, n in packing.best_two_fit(counts, size))
        assert got <= plain_best_two_fit(counts, size) + 1, counts
    # Greedy alone leaves 6 + 3 with a gap of 1; two pieces in place of the 3 fill it.
    assert packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)[0] == ((6, 2, 2), 1)


def test_packing_odd(odd, empty):
    rows = packing.packed(odd).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in odd.collect()}
    assert [r["length"] for r in rows if r["doc_id"] in (2, 3)] == [1, 1]
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert packing.packed(empty).count() == 0


# 4 personal data

FORMS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_spans(t):
    def luhn(d):
        return sum((n - 9 if n > 9 else n) for n in (int(c) * (1 + i % 2) for i, c in enumerate(d[::-1]))) % 10 == 0

    out = []
    for k, form in enumerate(FORMS):
        for m in re.finditer(form, t):
            d = re.sub(r"[^0-9]", "", m.group())
            if k == 1 and any(int(p) > 255 for p in m.group().split(".")) or k == 2 and not (16 <= len(d) <= 19 and luhn(d)) or k == 3 and not 8 <= len(d) <= 15:
                continue
            out.append((k, *m.span()))
    return out


def test_base_spans_equal_the_forms(texts):
    rng = random.Random(1)
    made = ["".join(rng.choice("a@.b1+2 -()_3é4") for _ in range(rng.randrange(40))) for _ in range(20000)]
    for t in [*texts.values(), *made, "4" * 16, "1.2.3.4.5.6.7.8", "a@b.c_x@d.e", "0000255.1.1.1", "+1 (803) 555-5351"]:
        assert pii.base_spans(t) == plain_spans(t), repr(t)
    assert pii.base_spans("1" * 200_000) == [] and pii.base_spans("a" * 200_000 + "@") == []


def test_contexts_discover_identifiers(spark):
    rows = [(i, f"some words then call me at +1 (80{i % 10}) 555-53{i:02d} today please") for i in range(40)]
    rows += [(100, "other words then call me at 803-555-5351 today please"), (101, "the year 2024 was long")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.personal_data(df).collect()}
    added = found[100]["added"]
    assert [(s["kind"], rows[40][1][s["start"] : s["end"]]) for s in added] == [(3, "803-555-5351")]
    assert not found[101]["added"] and len(found[3]["base"]) == 1


def test_discovered_identifiers_discover_more(spark):
    """Turn 1 finds odd numbers in the places of phone numbers; their own other places find numbers that never stand in those."""
    rows = [(i, f"word{i} then call me at +1 (80{i % 10}) 555-5{100 + i} today please") for i in range(150)]
    rows += [(200 + i, f"word{i} then call me at 803 555 {5300 + i} today please") for i in range(10)]
    rows += [(300 + i, f"and the desk of ours has line 803 555 {5300 + i} open daily") for i in range(10)]
    rows += [(400, "and the desk of ours has line (44) 771-99{} open daily".format("12")), (401, "he ran line 12 of it")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    values = lambda n: {r["doc_id"]: [text[r["doc_id"]][s["start"] : s["end"]] for s in r["added"]] for r in pii.personal_data(df, turns=n).collect()}
    one, two = values(1), values(2)
    assert all(one[200 + i] == two[200 + i] == [f"803 555 {5300 + i}"] for i in range(10))
    assert not any(one[300 + i] for i in range(10)) and all(two[300 + i] == [f"803 555 {5300 + i}"] for i in range(10))
    assert one[400] == [] and two[400] == ["44) 771-9912"] and two[401] == []
    base = lambda n: sorted((r["doc_id"], str(r["base"])) for r in pii.personal_data(df, turns=n).collect())
    assert base(1) == base(3)


def test_contexts_have_whole_words():
    w = pii.Words("x " + "a" * 5000 + " b:7 " + "c" * 5000 + " d")
    start = w.text.index("7")
    assert w.contexts(start, start + 1) == ["1|b", "3|b|" + pii._word("c" * 5000), "2|" + pii._word("a" * 5000) + " b"]
    assert pii._word("a" * 5000) != pii._word("a" * 5001)


def test_pii_query_and_odd(spark, texts, odd, empty):
    for r in queries.op4_pii(spark, DIR).collect():
        base = plain_spans(texts[r["doc_id"]])
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == i for b in base) for i in range(4)]
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))
    assert pii.personal_data(odd).count() == odd.count() and pii.personal_data(empty).count() == 0


# 5 nearest neighbours


def test_tree_is_exact_at_factor_one():
    rng = np.random.default_rng(1)
    points = vptree.unit(np.r_[rng.standard_normal((900, 8)), np.eye(8), np.eye(8)])
    asked = vptree.unit(np.r_[rng.standard_normal((40, 8)), np.eye(8)])
    row, which, got = vptree.Tree(points, leaf=8).search(asked, 5)
    all_ = vptree.distances(asked, points)
    for i in range(len(asked)):
        own = np.flatnonzero(row == i)
        assert np.allclose(np.sort(got[own])[:5], np.sort(all_[i])[:5])
        assert set(which[own]) >= set(np.flatnonzero(all_[i] <= np.sort(all_[i])[4]))


def test_nearest_is_exact_at_factor_one(spark):
    """Several cells, shards and blocks, a hot direction, repeated rows, and columns with names that the operator uses itself."""
    rng = np.random.default_rng(2)
    x = np.r_[rng.integers(-2, 3, (500, 4)), np.outer(rng.integers(1, 40, 300), [1, 2, 0, 0]), rng.integers(-2, 3, (60, 4)) * 7].astype(float)
    ids = rng.permutation(len(x))
    ids[-1] = ids[-2]  # one id twice
    rows = [(int(i), v.tolist(), 1, 2, 3) for i, v in zip(ids, x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell int, dims int, id int")
    index = vptree.build(df, 5, shard_rows=40, pivots=6)
    assert index.shards.count() > 10 and max(c[1].max() for c in index.cells.values()) > 1
    got = {}
    for r in vptree.nearest(index, df.where("vec_id % 3 = 0"), 5, block=7).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    valid = (x != 0).any(axis=1)
    u = vptree.unit(np.where(valid[:, None], x, 1.0))
    for i in np.flatnonzero(valid & (ids % 3 == 0)):
        if (ids == ids[i]).sum() > 1:
            continue
        cos = np.round(u @ u[i], 11)
        want = [v for _, v in sorted((-c, int(v)) for c, v, ok in zip(cos, ids, valid) if ok and v != ids[i])[:5]]
        assert [v for _, v in sorted(got[int(ids[i])])] == want
    assert all(int(i) not in got for i in ids[~valid] if (ids == i).sum() == 1)


def test_nearest(spark):
    vectors = spark.read.parquet(f"{DIR}/embeddings.parquet")
    rows = vectors.collect()
    x = np.array([r["embedding"] for r in rows], float)
    ids = np.array([r["vec_id"] for r in rows])
    n = np.sqrt((x * x).sum(1))
    hit = total = 0
    got: dict[int, list] = {}
    for r in queries.op5_vptree(spark, DIR).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in ids[ids % 50 == 0]:
        i = int(np.flatnonzero(ids == q)[0])
        cos = x @ x[i] / (n * n[i])
        want = [v for _, v in sorted((-c, v) for c, v in zip(cos, ids) if v != q)[:5]]
        own = sorted(got[q])
        assert [k for k, *_ in own] == [1, 2, 3, 4, 5] and all(abs(s - cos[int(np.flatnonzero(ids == v)[0])]) < 1e-12 for _, v, s in own)
        hit += len({v for _, v, _ in own} & set(want))
        total += 5
    assert hit / total >= 0.9


def test_nearest_odd(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [0.0, 1.0]), (8, [1.0, 0.0, 0.0]), (9, [1.0, 0.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = vptree.nearest(vptree.build(df, 3), df.where("vec_id = 0"), 3).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in out] == [(1, 1.0), (2, 1.0), (9, 1.0)]
    empty = df.limit(0)
    assert vptree.nearest(vptree.build(empty), empty).count() == 0


# 6 fingerprints


def brute_signatures(text, chain=2, reach=6):
    anchors = set(spotsigs.ANCHORS)
    w = [x for x in re.split(r"[^\w]+|_", text.lower()) if x]
    out = set()
    for i, x in enumerate(w):
        if x in anchors:
            c = [y for y in w[i + 1 : i + 1 + reach] if y not in anchors][:chain]
            if c:
                out.add((x, *c))
    return out


def test_spots_equal_brute_force(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sizes = {r["doc_id"]: r["n"] for r in df.select("doc_id", F.size(spotsigs.signatures(F.col("text"))).alias("n")).collect()}
    assert all(sizes[k] == max(1, len(brute_signatures(t))) for k, t in texts.items())


@pytest.mark.parametrize("bucket", [2000, 4 << 20])
def test_neighbours(spark, docs, texts, bucket):
    ids = sorted(texts)
    rows = {r["doc_id"]: r["next_text"] for r in spotsigs.with_next(docs, bucket).where("guest = 0").collect()}
    assert len(rows) == len(ids)
    assert all(rows[k] == texts[ids[(i + 1) % len(ids)]] for i, k in enumerate(ids))


def test_fingerprint_query(spark, texts):
    ids = sorted(texts)
    rows = {r["doc_id"]: r for r in queries.op6_spotsigs(spark, DIR).collect()}
    jaccard = lambda a, b: len(a & b) / len(a | b)
    for i, k in enumerate(ids):
        t, after, r = texts[k], texts[ids[(i + 1) % len(ids)]], rows[k]
        half = len(t) // 2
        assert r["edited_sha256"] == hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest() and r["n_chars"] == len(t)
        own, other, nxt = (set(x.split(".")) for x in (r["fingerprint"], r["edited_fingerprint"], rows[ids[(i + 1) % len(ids)]]["fingerprint"]))
        assert abs(r["near_edited"] - jaccard(own, other)) < 1e-12 and abs(r["near_next"] - jaccard(own, nxt)) < 1e-12


def test_similar_equals_brute_force(spark):
    rng = random.Random(6)
    base = ["the " + " ".join(rng.choice("alpha beta gamma delta the of and in omega sigma".split()) + str(rng.randrange(30)) + " the" for _ in range(60)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(30):
        w = base[i % 6].split()
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = "zeta"
        rows.append((10 + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    classes, pairs = spotsigs.similar(df, 0.8)
    of = {r["doc_id"]: r["class_id"] for r in classes.collect()}
    s = {k: frozenset(brute_signatures(t)) for k, t in rows}
    want = {(a, b) for a in set(of.values()) for b in set(of.values()) if a < b and len(s[a] & s[b]) / len(s[a] | s[b]) >= 0.8}
    assert all((s[a] == s[b]) == (of[a] == of[b]) for a in s for b in s)
    assert {(r["a"], r["b"]) for r in pairs.collect()} == want and want


def test_fingerprints_odd(odd, empty):
    rows = spotsigs.compare_neighbours(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1 for r in rows)
    assert spotsigs.compare_neighbours(empty).count() == 0
    assert [r["near_next"] for r in spotsigs.compare_neighbours(odd.limit(1)).collect()] == [1.0]


# 7 SimHash


def brute_components(ids, fps, distance=4):
    label = list(range(len(ids)))
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= distance
    while True:
        new = [min(label[j] for j in np.flatnonzero(near[i])) for i in range(len(ids))]
        if new == label:
            return [ids[x] for x in label]
        label = new


@pytest.mark.parametrize("block", [simhash.BLOCK, 20])
def test_links_connect_as_brute_force(spark, block):
    rng = np.random.default_rng(8)
    fps = {int(x) for x in rng.integers(0, 2**64, 60, dtype=np.uint64)}
    for x in list(fps)[:12]:
        y = x
        for step in range(rng.integers(1, 40)):
            for bit in rng.integers(0, 64, rng.integers(0, 5)):
                y ^= 1 << int(bit)
            fps.add(y)
            if step % 3 == 0:
                y = x
    ids = sorted(fps)
    signed = [x - 2**64 if x >= 2**63 else x for x in ids]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 4, block)
    root = {r["node"]: r["root"] for r in components(edges).collect()}
    want = brute_components(signed, np.array(ids, np.uint64))
    got = [root.get(x, x) for x in signed]
    same = lambda xs: {frozenset(i for i, y in enumerate(xs) if y == x) for x in xs}
    assert same(got) == same(want)


def test_components_of_paths(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (7, 7)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(1, 61)) and out[101] == out[103] == 100
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_query(spark, texts):
    rows = {r["doc_id"]: r for r in queries.op7_simhash(spark, DIR).collect()}
    ids = sorted(texts)

    def plain(t):
        import xxhash

        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))
        s = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0

    fps = [plain(texts[k]) for k in ids]
    assert [rows[k]["fingerprint"] for k in ids] == [f"{x:016x}" for x in fps]
    assert [rows[k]["component_id"] for k in ids] == brute_components(ids, np.array(fps, np.uint64))


def test_simhash_odd(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count() and {r["component_id"] for r in rows if r["doc_id"] in (2, 3, 4)} == {2}
    one = simhash.one_of_each(odd)
    assert one.columns == odd.columns
    left = [r["doc_id"] for r in one.collect()]
    assert sorted(x for x in left if x is not None) == [1, 2, 5, 7, 9, 10, 10] and None in left
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


# 8 language


def plain_bits(counts, context, byte, least):
    """Bits of a byte after a context (bytes), by the definition: orders from the context's own down to none, with exclusion."""

    def chance(ctx, b):
        seen: dict[int, int] = {}
        for g, n in counts.items():
            if g[3 - len(ctx) : 3] == ctx:
                seen[g[3]] = seen.get(g[3], 0) + n
        shorter = (lambda x: 1 / 256) if not ctx else (lambda x: chance(ctx[1:], x))
        if not seen or len(ctx) == 3 and sum(seen.values()) < least:
            return shorter(b)
        whole = sum(seen.values()) + len(seen)
        if b in seen:
            return seen[b] / whole
        return len(seen) / whole * shorter(b) / max(1e-9, 1 - sum(shorter(x) for x in seen))

    return -np.log2(chance(context, byte))


@pytest.mark.parametrize("least", [1, 3])
def test_ppm_code_lengths(least):
    text = "the cat sat on the mat, the chat est là"
    grams, n = langid.gram_counts([text] * 2)
    own = langid.Context(grams, n, least)
    counts = {int(g).to_bytes(4, "big"): int(k) for g, k in zip(grams, n)}
    rng = random.Random(3)
    runs = [*counts, *(bytes(rng.choice(b"theca \n\xc3z") for _ in range(4)) for _ in range(60))]
    got = own.bits(np.array([int.from_bytes(r, "big") for r in runs], np.uint32))
    assert np.allclose(got, [plain_bits(counts, r[:3], r[3], least) for r in runs], atol=1e-3)
    for context in (b"the", b"zzz", b" ca"):
        all_ = own.bits(np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint32))
        assert abs(np.exp2(-all_.astype(float)).sum() - 1) < 1e-4


def test_ppm_lengths_equal_one_by_one():
    m = langid.Ppm({g: langid.gram_counts([t]) for g, t in (("en", "the cat sat on the mat"), ("fr", "le chat est là"))}, least=1)
    texts = ["the chat", "", "là", "zzz" * 5, "x", "the cat and le chat " * 40_000]
    want = []
    for t in texts:
        s = b"\n\n\n" + t.encode()
        runs = np.array([int.from_bytes(s[i : i + 4], "big") for i in range(len(s) - 3)], np.uint32)
        want.append(m.bits(runs).sum(axis=0, dtype=float) if len(runs) else np.zeros(2))
    assert np.allclose(m.lengths(texts), want, rtol=1e-6, atol=1e-3)


def test_many_languages_in_several_models(spark):
    """Past the number of languages that one model holds, the result is that of one model."""
    rng = random.Random(4)
    words = {f"l{i:02d}": ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(12)] for i in range(30)}
    rows = [(k, " ".join(rng.choice(w) for _ in range(30)), g) for k, (g, w) in enumerate((g, w) for g, w in words.items() for _ in range(4))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, several = langid.train(df), langid.train(df, languages=4)
    assert one.parts == 1 and several.parts == 8
    got, want = ({r["doc_id"]: r for r in langid.identify(df, m, ["doc_id", "lang"]).collect()} for m in (several, one))
    assert all(got[k]["lang_pred"] == want[k]["lang_pred"] and abs(got[k]["score"] - want[k]["score"]) < 1e-6 for k in want)
    assert sum(r["lang"] == r["lang_pred"] for r in got.values()) > 110


def test_langid_held_out(spark):
    d = "/root/testdata/sf0.01"
    true = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    held = [r for r in queries.op8_langid(spark, d).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == true[r["doc_id"]] for r in held) / len(held) > 0.98


def test_langid_odd(odd, empty):
    model = langid.train(odd)
    rows = langid.identify(odd, model, ["doc_id", "text"]).collect()
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == {2, 3, 4, 9} and all(0 <= r["score"] <= 1 for r in rows)
    assert langid.train(empty) is None and {r["lang_pred"] for r in langid.identify(odd, None, ["doc_id"]).collect()} == {"und"}
    assert langid.identify(empty, model, ["doc_id"]).count() == 0


# 9 token counts


def greedy(word, starts, insides):
    n, at = 0, 0
    while at < len(word):
        own = starts if at == 0 else insides
        end = next((e for e in range(len(word), at, -1) if word[at:e] in own), None)
        if end is None:
            return 0
        n, at = n + 1, end
    return n


def test_automaton_equals_greedy():
    rng = random.Random(9)
    for _ in range(60):
        starts = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 12))}
        insides = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(0, 12))}
        a = tokencount.Automaton(starts, insides)
        for _ in range(200):
            w = "".join(rng.choice("abcd") if rng.random() < 0.05 else rng.choice("abc") for _ in range(rng.randrange(0, 14)))
            assert a.count(w) == greedy(w, starts, insides), (w, starts, insides)


def test_token_counts(spark, texts, odd, empty):
    import public_tokenizers

    starts, insides = map(set, tokencount.sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    for r in queries.op9_token_counts(spark, DIR).collect():
        counts = [greedy(w, starts, insides) for w in tokencount._WORD.findall(texts[r["doc_id"]])]
        assert (r["n_words"], r["n_tokens"], r["n_unknown"]) == (len(counts), sum(c or 1 for c in counts), counts.count(0))
    rows = tokencount.token_counts(odd).collect()
    assert len(rows) == odd.count() and [r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 4)] == [0, 0, 0]
    assert tokencount.token_counts(empty).count() == 0


# 10 line dedup


def test_chunks_are_shift_resistant():
    rng = random.Random(5)
    passage = [f"line {rng.random()} of it".encode() for _ in range(40)]
    a = [b"head"] * 3 + passage + [b"tail"]
    b = [b"other one", b"more"] + passage + [b"end", b"ends"]
    cut = lambda x: {tuple(x[lo:hi]) for lo, hi in linededup.chunks(x, 1)}
    common = cut(a) & cut(b)
    assert sum(map(len, common)) >= 34
    assert [c for r in linededup.chunks(a, 0) for c in range(*r)] == list(range(len(a)))


def test_shared_passages_go_but_the_first(spark):
    rng = random.Random(7)
    line = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(9))
    shared = [[line() for _ in range(7)], [line() for _ in range(12)], [" ".join(line() for _ in range(6))]]
    rows, clean = [], {}
    for i in range(60):
        own = [line() for _ in range(rng.randrange(3, 20))]
        at = rng.randrange(len(own))
        clean[i] = own
        rows.append((i, "\n".join(own[:at] + shared[i % 3] + own[at:]) if i < 45 else "\n".join(own + ["short line"])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in linededup.dedup_lines(df).collect()}
    for i, text in rows:
        if i < 3 or i >= 45:
            assert out[i]["text"] == text and out[i]["removed_lines"] == 0
        else:
            assert out[i]["text"] == "\n".join(clean[i]), i


def brute_line_dedup(docs, least=25):
    """What stays of each (doc_id, text), from the definition: every two neighbouring lines, and long lines, by their first place."""
    first, out = {}, {}
    rows = sorted(((d, t.split("\n")) for d, t in docs), key=lambda x: x[0])
    grams = lambda w: [(i, i + 2) for i in range(len(w) - 1)] + [(i, i + 1) for i, x in enumerate(w) if x.count(" ") >= 24]
    for d, w in rows:
        for a, b in grams(w):
            first.setdefault(tuple(w[a:b]), (d, a))
            first[tuple(w[a:b])] = min(first[tuple(w[a:b])], (d, a))
    for d, w in rows:
        marked = sorted((a, b) for a, b in grams(w) if first[tuple(w[a:b])] != (d, a))
        runs = []
        for a, b in marked:
            if runs and a < runs[-1][1]:
                runs[-1][1] = max(b, runs[-1][1])
            else:
                runs.append([a, b])
        gone = {i for a, b in runs if sum(len(x.split()) for x in w[a:b]) >= least for i in range(a, b)}
        out[d] = "\n".join(x for i, x in enumerate(w) if i not in gone)
    return out


@pytest.mark.parametrize("bits", [64, 6])
def test_line_dedup_equals_brute_force(spark, texts, bits):
    """Real documents and made ones that share lines; with 6 bits, most hashes are shared by different lines and must match nothing."""
    rng = random.Random(11)
    pool = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.choice([0, 1, 5, 9, 30]))) for _ in range(25)]
    rows = [(k, t) for k, t in texts.items() if t] if bits == 64 else []
    rows += [(100_000 + i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 30)))) for i in range(60)]
    rows = [(k, t) for k, t in rows if t]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = linededup.content_hash if bits == 64 else lambda b: zlib.crc32(b) % 64
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(df, hashed=hashed).collect()}
    if bits == 64:
        assert got == brute_line_dedup(rows)
        lines = {x for _, t in rows for x in t.split("\n")}
        assert {x for t in got.values() for x in t.split("\n")} >= lines - {""}
    else:  # nothing but true repeats may go
        want = brute_line_dedup(rows)
        assert all(len(got[k]) >= len(want[k]) for k in got)


def test_line_dedup_odd(spark, odd, empty):
    out = linededup.dedup_lines(odd)
    assert out.columns == [*odd.columns, "removed_lines"]
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect()) == sorted((r["doc_id"] or 0, r["text"] or "") for r in odd.collect())
    assert linededup.dedup_lines(empty).count() == 0
    copy = odd.where("doc_id = 7").withColumn("doc_id", F.lit(8).cast("long"))
    assert {r["doc_id"]: r["text"] for r in linededup.dedup_lines(odd.where("doc_id = 7").union(copy)).collect()}[8] == ""
    clash = linededup.dedup_lines(odd.select("*", *(F.lit(9).alias(c) for c in ("removed_lines", "c0", "places", "h", "lo", "d", "t", "is_first"))))
    assert clash.columns == [*odd.columns, "c0", "places", "h", "lo", "d", "t", "is_first", "removed_lines"]
    assert {r["removed_lines"] for r in clash.collect()} == {0} and {r["c0"] for r in clash.collect()} == {9}
