"""Groups of similar shingle sets against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from gritstone.llm import _components, _store
from gritstone.llm import shinglesets


def _want(rows, least=0.8):
    sets = [set(shinglesets.shingle_set(t, 5).tolist()) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if not union or len(sets[i] & sets[j]) * 5 >= 4 * union:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return sorted(rows[i][0] for i in range(len(rows)) if root(i) == i)


def _documents(seed, families, copies, edits, base=None):
    r = random.Random(seed)
    rows = []
    for _ in range(families):
        words = (base or []) + [f"w{r.randrange(5000)}" for _ in range(r.choice([3, 12, 60, 200, 400]))]
        for _ in range(copies):
            own = list(words)
            for _ in range(r.randrange(edits + 1)):
                own[r.randrange(len(own))] = f"e{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("rows", [_documents(1, 60, 4, 6), _documents(2, 3, 60, 8), _documents(3, 60, 2, 3, [f"b{i}" for i in range(150)])], ids=["small", "large", "passage"])
def test_one_of_each_against_all_pairs(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(x["doc_id"] for x in shinglesets.one_of_each(docs, block=32, hot_sets=8).collect())
    assert got == _want(rows)


def test_dealt_hashes_of_alike_sketches_meet():
    rng = random.Random(5)
    hot = np.array(sorted(rng.sample(range(500), 60)), np.int64)
    for _ in range(3000):
        pool = np.array(rng.sample(range(500), 60), np.int64)
        size = rng.choice([shinglesets.SKETCH] * 3 + [1, 2, 4, 7, 20])
        a, b = (np.sort(rng.sample(pool.tolist(), size)).astype(np.int64) for _ in range(2))
        shared = len(np.intersect1d(a, b))
        if shared >= (shinglesets.ALIKE if size == shinglesets.SKETCH else 0.8 * size):
            assert len(np.intersect1d(shinglesets.dealt_hashes(a, hot), shinglesets.dealt_hashes(b, hot)))


def test_finely_dealt_hashes_of_similar_sets_meet(spark):
    """Sets of many sizes that have a passage in common: similar ones share a dealt hash, and the passage alone is not dealt by all."""
    rng = random.Random(7)
    passage = rng.sample(range(10**6), 150)
    sets = []
    for size in (1, 4, 9, 40, 190, 203, 204, 205, 206, 230, 255, 256, 257, 300, 319, 400):
        for base in ([], passage[: size // 2]):
            first = base + rng.sample(range(10**6, 10**9), size - len(base))
            for changed in (0, size // 10, size // 9, size // 4):
                sets.append(sorted(set(first[changed:] + rng.sample(range(10**9, 10**12), changed))))
    rows = [(i, len(x), x[: shinglesets.FINE]) for i, x in enumerate(sets)]
    fine = spark.createDataFrame(rows, "id long, size long, least array<long>")
    dealt = {}
    for x in shinglesets.finely_dealt(fine).collect():
        dealt.setdefault(x["id"], set()).add(x["token"])
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 10 * len(set(sets[i]) & set(sets[j])) >= 8 * len(set(sets[i]) | set(sets[j]))]
    assert len(pairs) > 50
    assert all(dealt[i] & dealt[j] for i, j in pairs)


def test_grid_of_fingerprints_links_what_sketches_do_not(spark):
    """Sketches that share nothing leave fingerprints within 5 bits, or equal ones, as the only way; the sets decide in the end."""
    words = [f"w{i}" for i in range(300)]
    near = " ".join([*words[:-1], "x"])
    far = " ".join(f"y{i}" for i in range(300))
    texts = [" ".join(words), near, far, " ".join(words[:150]), " ".join(words[:149]), " ".join(words[150:])]
    fps = [5, 5 ^ (31 << 40), 5 ^ (1 << 63), 1 << 20, 1 << 20, (1 << 20) ^ (63 << 30)]
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    sizes = [len(shinglesets.shingle_set(t, 5)) for t in texts]
    sets = spark.createDataFrame([(i, n, [1000 * i + k for k in range(shinglesets.SKETCH)], fp) for i, (n, fp) in enumerate(zip(sizes, signed))], "id long, size long, least array<long>, fp long")
    of = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = shinglesets.links(sets, lambda ids: of.join(ids, "id"), 5).distinct().collect()
    assert sorted((r["a"], r["b"]) for r in found) == [(0, 1), (3, 4)]


def test_pipeline_drops_copies_far_apart_in_bits(spark):
    """Ten of 500 words changed leave a similarity of about 0.82, and over 4 bits of a fingerprint between the two."""
    import corpus_pipeline
    from gritstone.llm import simhash

    words = [f"w{i}" for i in range(500)]
    other = [f"x{i}" if i % 50 == 25 else w for i, w in enumerate(words)]
    texts = [" ".join(words), " ".join(other)]
    assert (simhash.fingerprint(texts[0], 5) ^ simhash.fingerprint(texts[1], 5)).bit_count() > 4
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [x["doc_id"] for x in corpus_pipeline.near_duplicates(spark, docs, "").collect()] == [0]


def test_odd_and_empty(spark, odd, empty):
    assert shinglesets.one_of_each(odd).count() == 8
    assert shinglesets.one_of_each(empty).count() == 0


def test_folder_where_the_session_names_none():
    """Spark refuses to change the setting while it runs, so the folder is remembered instead."""
    from types import SimpleNamespace

    from gritstone.llm import _store

    def no_set(*_):
        raise AssertionError("the setting can't be changed")

    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default, set=no_set), sparkContext=SimpleNamespace(applicationId="app-of-a-test"))
    assert _store.shared_folder(session) == _store.shared_folder(session)
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: "hdfs://a/b/"))
    assert _store.shared_folder(named) == "hdfs://a/b"


def test_narrow_tables_go_to_few_files(spark):
    """A process starts for each file on a local disk, and 211 shuffle partitions made 211 files of few rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    try:
        edges = _store.keep(spark.range(0, 2000, 1, 211).selectExpr("id div 2 * 2 as a", "id as b"))
        roots = _store.keep(_components.components(edges), narrow=True)
        most = max(2 * spark.sparkContext.defaultParallelism, 27)
        assert 0 < len(roots.inputFiles()) <= most < 211
        assert len(_components.components(edges).inputFiles()) <= most
        assert roots.count() == 1000 and roots.where("node <> root + 1").isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
