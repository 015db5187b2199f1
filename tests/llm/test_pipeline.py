"""The corpus pipeline's stages, each judged on its own input."""

from __future__ import annotations

import re

import numpy as np
import pytest

import corpus_pipeline
from gritstone.llm import simhash
from gritstone.llm._store import keep

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = [docs]
    for _, f in corpus_pipeline.STAGES:
        out.append(keep(f(spark, out[-1], DIR)))
    return out


def test_columns(steps):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(s.columns == steps[0].columns and s.dtypes == steps[0].dtypes for s in steps[:5])


def test_language_keeps_documents_with_letters(steps):
    want = {r["doc_id"] for r in steps[0].collect() if re.search(r"[^\W\d_]", r["text"] or "")}
    assert {r["doc_id"] for r in steps[1].collect()} == want


def test_lines_only_take_from_texts(steps):
    before = {r["doc_id"]: r["text"] for r in steps[1].collect()}
    for r in steps[2].collect():
        rest = iter(before[r["doc_id"]].split("\n"))
        assert all(line in rest for line in r["text"].split("\n"))


def test_one_of_each_group_stays(steps):
    rows = steps[2].collect()
    fps = np.array([simhash.fingerprint(r["text"], 5) for r in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 4
    label = list(range(len(rows)))
    while (new := [min(label[j] for j in np.flatnonzero(near[i])) for i in range(len(rows))]) != label:
        label = new
    groups: dict[int, set] = {}
    for r, x in zip(rows, label):
        groups.setdefault(x, set()).add(r["doc_id"])
    assert sorted(r["doc_id"] for r in steps[3].collect()) == sorted(min(g) for g in groups.values())


def test_mix_and_pack(steps):
    mixed = steps[4].collect()
    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert abs(words(mixed) / words(steps[3].collect()) - 1.5) < 0.02
    packed = steps[5].collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in mixed}


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_odd_documents(spark, request, kind):
    docs = request.getfixturevalue(kind)  # with extra columns of names that operators use themselves
    for _, f in corpus_pipeline.STAGES:
        docs = keep(f(spark, docs, DIR))
    assert (docs.count() > 0) == (kind == "odd")
