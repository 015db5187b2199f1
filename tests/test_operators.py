"""Operators on small tables made by hand, with nulls and ties."""

from __future__ import annotations

import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from gritstone.functions import scalars
from gritstone.operators import aggs, decision, graph, joins, quality, windows
from gritstone.sources import html, match_json, scan, sinks
from gritstone.streaming import incremental


def test_rolling_leaves_out_the_row_and_restarts(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([1.0, None, 3.0, 5.0, 7.0])] + [("b", 9, 4.0)], "k string, d int, v double")
    out = df.select("k", "d", *windows.rolling({"v": F.col("v")}, ["k"], ["d"], [3]), F.count("*").over(windows.previous(["k"], ["d"], 3)).alias("n")).orderBy("k", "d").collect()
    assert [r["v_3"] for r in out] == [None, 1.0, 1.0, 2.0, 4.0, None]
    assert [r["n"] for r in out] == [0, 1, 2, 3, 3, 0]


def test_longest_streak(spark):
    df = spark.createDataFrame([("a", i, f) for i, f in enumerate([True, True, None, True, False])] + [("b", 0, False)], "k string, d int, f boolean")
    assert {r["k"]: r["longest_streak"] for r in windows.longest_streak(df, F.col("f"), ["k"], ["d"]).collect()} == {"a": 2, "b": 0}


@pytest.mark.parametrize("strict,want", [(True, [None, "x", "z"]), (False, ["x", "z", "z"])])
def test_asof(spark, strict, want):
    left = spark.createDataFrame([("k", 1), ("k", 5), ("k", 9)], "k string, t int")
    right = spark.createDataFrame([("k", 1, "x", 1), ("k", 5, "y", 1), ("k", 5, "z", 2), ("q", 1, "no", 1)], "k string, t int, v string, o int")
    out = joins.asof_latest(left, right, ["k"], "t", "t", ["v", "o"], strict, tie="o").orderBy("t").collect()
    assert [r["v"] for r in out] == want


def test_asof_null_time_has_no_partner(spark):
    left = spark.createDataFrame([("k", None), ("k", 3)], "k string, t int")
    right = spark.createDataFrame([("k", 1, "x")], "k string, t int, v string")
    assert {r["t"]: r["v"] for r in joins.asof_latest(left, right, ["k"], "t", "t", ["v"]).collect()} == {None: None, 3: "x"}


def test_anti_ignores_nulls_on_the_right(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (None,)], "k int")
    assert [r["k"] for r in joins.anti(a, b, ["k"]).collect()] == [1]


def test_fuzzy_best(spark):
    names = spark.createDataFrame([("United Manchester",), ("Arsenl London",), ("Nobody",)], "n string")
    dim = spark.createDataFrame([("Manchester United",), ("Arsenal London",)], "c string")
    assert {r["n"]: r["c"] for r in joins.fuzzy_best(names, dim, "n", "c").collect()} == {"United Manchester": "Manchester United", "Arsenl London": "Arsenal London"}


def _token_sort_ratio(a, b):
    a, b = (" ".join(sorted(x.lower().split())) for x in (a, b))
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return 200.0 * row[-1] / (len(a) + len(b))


def test_fuzzy_best_without_shared_prefixes(spark):
    names = spark.createDataFrame([("Bornemouth",), ("Arsenl",), ("rsenal",), ("Nobody",)], "n string")
    dim = spark.createDataFrame([("Bournemouth",), ("Arsenal",)], "c string")
    assert {r["n"]: r["c"] for r in joins.fuzzy_best(names, dim, "n", "c").collect()} == {"Bornemouth": "Bournemouth", "Arsenl": "Arsenal", "rsenal": "Arsenal"}


@pytest.mark.parametrize("least", [90.0, 75.0])
def test_fuzzy_best_against_all_pairs(spark, least):
    r = random.Random(5)
    dim = sorted({" ".join("".join(r.choices("abcd", k=r.randint(1, 9))) for _ in range(r.randint(1, 4))) for _ in range(150)})
    names = set()
    for x in dim:
        letters = list(x)
        for _ in range(r.randint(1, 4)):
            letters[(i := r.randrange(len(letters))) : i + r.randint(0, 1)] = r.choices("abcd", k=r.randint(0, 1)) or ["a"]
        words = "".join(letters).split()
        r.shuffle(words)
        names.add(" ".join(words))
    want = {}
    for n in names:
        score, entry = min((-_token_sort_ratio(n, c), c) for c in dim)
        if round(-score) >= least:
            want[n] = (entry, round(-score, 4))
    got = joins.fuzzy_best(spark.createDataFrame([(n,) for n in names], "n string"), spark.createDataFrame([(c,) for c in dim], "c string"), "n", "c", least)
    assert {x["n"]: (x["c"], x["score"]) for x in got.collect()} == want


@pytest.mark.parametrize(
    "edges,want",
    [
        ([("c", x, 1.0) for x in "123"] + [(x, "c", 1.0) for x in "123"], {"c": 1.0, "1": 0.0}),
        ([("a", "b", 1.0), ("b", "c", 1.0), ("c", "d", 1.0)], {"b": 2 / 6, "c": 2 / 6, "a": 0.0}),
        ([(x, y, 1.0) for x in "abcd" for y in "abcd" if x != y], dict.fromkeys("abcd", 0.0)),
        ([("a", "b", 5.0), ("a", "x", 1.0), ("x", "b", 1.0)], {"x": 0.5, "a": 0.0, "b": 0.0}),
    ],
)
def test_brandes(edges, want):
    found = graph.brandes(edges)
    assert all(math.isclose(found[k], v) for k, v in want.items())


def test_betweenness_empty(spark):
    empty = spark.createDataFrame([], "m string, a int, b int, w int")
    out = graph.betweenness(empty, ["m"], "a", "b", "w")
    assert out.columns == ["m", "node", "betweenness"] and out.count() == 0


@pytest.mark.parametrize("text,want", [("2017-2018", "2017-2018"), ("2017/18", "2017-2018"), ("17-18", "2017-2018"), ("1718", "2017-2018"), ("2017", "2017-2018"), ("9899", "1998-1999"), ("x", None), (None, None)])
def test_season(spark, text, want):
    assert spark.createDataFrame([(text,)], "s string").select(scalars.season(F.col("s"))).first()[0] == want


def test_entropy_and_weighted_mean(spark):
    df = spark.createDataFrame([("a", 0.5, 2.0), ("a", 0.5, None), ("b", 1.0, 4.0)], "k string, p double, w double")
    out = {r["k"]: r for r in df.groupBy("k").agg(aggs.entropy(F.col("p")).alias("e"), aggs.weighted_mean(F.col("p"), F.col("w")).alias("m")).collect()}
    assert math.isclose(out["a"]["e"], 1.0) and out["b"]["e"] is None and out["a"]["m"] == 0.5


def test_stakes_and_bankroll(spark):
    assert decision.kelly_stake(1000, 0.5, 2.2, False) == round(1000 * min(0.05, (0.5 * 1.2 - 0.5) / 1.2 / 2), 2)
    assert decision.kelly_stake(1000, 0.2, 2.0, False) == 0.0
    assert decision.kelly_stake(1000, 0.9, 3.0, True) == 50.0
    rows = [(1, "H", 0.9, 2.0, True), (2, "D", 0.5, 3.0, False), (3, "H", 0.1, 2.0, True)]
    df = spark.createDataFrame(rows, "n int, outcome string, prob double, odds double, won boolean")
    out = decision.simulate(df, [], ["n"]).orderBy("n").collect()
    assert [r["stake"] for r in out] == [50.0, 52.5, 0.0]
    assert [r["bankroll"] for r in out] == [1050.0, 997.5, 997.5]


def test_quality_gate(spark):
    df = spark.createDataFrame([(1, 0.5), (None, 2.0)], "k int, p double")
    report = quality.report(df, [quality.not_null("k"), quality.probability("p", "warn"), quality.not_null("k", mostly=0.5)])
    assert [r["passed"] for r in report.collect()] == [False, False, True]
    with pytest.raises(ValueError):
        quality.gate(report)


def test_merges(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B", 1), (3, "C", 1)], "k int, v string, extra int")
    pairs = lambda df: sorted((r["k"], r["v"]) for r in df.collect())
    assert pairs(sinks.merged_insert(old, new, ["k"])) == [(1, "a"), (2, "b"), (3, "C")]
    assert pairs(sinks.merged_replace(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    assert pairs(sinks.updated(old, new.select("k", "v"), ["k"])) == [(1, "a"), (2, "B")]


def test_one_load_equals_two(spark, tmp_path):
    rows = [(i % 3, i, float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    last = lambda x: x.withColumn("prev", F.lag("v").over(windows.ordered(["k"], ["t"])))
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    incremental.refresh(spark, a, df, ["k", "t"], last)
    incremental.refresh(spark, b, df.where("t < 17"), ["k", "t"], last)
    incremental.refresh(spark, b, df, ["k", "t"], last)
    incremental.refresh(spark, b, df, ["k", "t"], last)
    assert sorted(spark.read.parquet(a).collect(), key=str) == sorted(spark.read.parquet(b).collect(), key=str)


def test_stream_counts_each_file_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    spark.createDataFrame([(1, "a")], "k int, v string").write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    incremental.stream_once(spark, src, schema, out, ["k"], mark)
    spark.createDataFrame([(1, "A"), (2, "b")], "k int, v string").write.mode("append").parquet(src)
    got = incremental.stream_once(spark, src, schema, out, ["k"], mark)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "A"), (2, "b")]


def test_csv_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("n\nÉlan\n".encode())
    (tmp_path / "b.csv").write_bytes("n\nÉmile\n".encode("latin-1"))
    assert sorted(r["n"] for r in scan.csv(spark, str(tmp_path)).collect()) == ["Élan", "Émile"]


def test_html_tables(spark):
    rows = "".join(f"<tr><td data-stat='team'><a href='/x/verein/{i}/y'>T{i}</a></td><td data-stat='gf'>{i} (1)</td><td>{i},5 mio. €</td></tr>" for i in range(12))
    page = f"<table><tr><th data-stat='team'>Club</th><th data-stat='gf'>Goals</th><th>Value</th></tr>{rows}</table>"
    assert html.rows_by_attribute(page)[2] == {"team": "T2", "gf": "2"}
    assert html.rows_by_header(page, ["Club", "Goals"])[3]["Club"] == "T3"
    assert html.linked_rows(page)[4] == {"name": "T4", "id": "4", "value": "4,5 mio. €"}
    df = spark.createDataFrame([(1, page), (2, None)], "k int, h string")
    assert html.explode_pages(df, "k", "h").count() == 12


def test_match_json(spark, tmp_path):
    side = lambda i: {"teamId": i, "name": f"t{i}", "field": "home", "players": [{"playerId": 10 * i, "name": "p", "stats": {"ratings": {"0": 6.0, "90": 7.1, "12": 6.5}}}], "formations": [{"formationId": 2, "formationName": "442", "playerIds": [10 * i], "formationSlots": [1]}]}
    game = {"matchId": "m", "events": [{"eventId": 5, "minute": 1, "type": {"value": 1, "displayName": "Pass"}, "teamId": 1, "qualifiers": [{"type": {"value": 233, "displayName": "Opp"}, "value": "6"}]}, {"eventId": 6, "type": {"value": 7, "displayName": "Tackle"}, "teamId": 2}], "home": side(1), "away": side(2), "playerIdNameDictionary": {"10": "Ann", "20": "Bo"}}
    (tmp_path / "m.json").write_text(json.dumps(game))
    m = scan.json_files(spark, str(tmp_path), match_json.MATCH)
    e = match_json.events(m).orderBy("row_num").collect()
    assert [(r["row_num"], r["type_id"], r["is_shot"]) for r in e] == [(0, 1, False), (1, 7, False)]
    assert [r["qualifier_value"] for r in match_json.qualifiers(match_json.events(m), ["ws_match_id", "row_num"]).collect()] == ["6"]
    assert {r["player_id"]: r["rating"] for r in match_json.player_match(m).collect()} == {10: 7.1, 20: 7.1}
    assert match_json.formations(m).count() == 2 and match_json.team_match(m).count() == 2 and match_json.match_meta(m).count() == 1
    assert {r["player_id"]: r["player_name"] for r in match_json.players_ref(m).collect()} == {10: "Ann", 20: "Bo"}


def test_dates(spark):
    df = spark.createDataFrame([("2024-03-05T10:00", "05/03/24"), ("nope", "5/3/2024"), (None, "99/99/99")], "a string, b string")
    out = df.select(scalars.iso_date(F.col("a")).alias("a"), scalars.day_first(F.col("b")).alias("b")).collect()
    day = dt.date(2024, 3, 5)
    assert [tuple(r) for r in out] == [(day, day), (None, day), (None, None)]


def test_stacking(spark):
    rows = [(float(i % 7), float(i % 5) if i % 11 else None, float((i % 7) // 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    base, meta = decision.stacked(df, df, ["a", "b"], ["a"], "y")
    scored = decision.probabilities(meta, decision.probabilities(base, df, ["b0", "b1", "b2"]), ["p0", "p1", "p2"])
    done = decision.calibrated(scored, decision.isotonic(scored, ["p0", "p1", "p2"], "y"), ["p0", "p1", "p2"])
    r = done.agg(F.min(F.col("p0") + F.col("p1") + F.col("p2")).alias("lo"), F.avg(((F.col("p0") > 0.5) == (F.col("y") == 0.0)).cast("int")).alias("hit")).first()
    assert math.isclose(r["lo"], 1.0) and r["hit"] > 0.9


def test_stacking_of_both_perspectives(spark):
    """The away model learns the swapped target, the search takes the grid's best, and calibration rows are a half."""
    rows = [(float(i % 7), float((i * 5) % 7), float((i % 7) // 3), i) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, y double, t int").coalesce(1).cache()
    models = decision.perspectives(df, df, ["b"], ["a"], "y", [(5.0, 0.0), (0.001, 0.0)])
    assert [n for _, names in models for n in names] == ["h0", "h1", "h2", "a2", "a1", "a0", "c0", "c1", "c2"]
    assert models[1][0].stages[-1].getRegParam() == 0.001 and models[1][0].stages[-1].getLabelCol() == "__swapped"
    scored = decision.probabilities(*models[1][:1], df, models[1][1])
    assert scored.agg(F.avg(((F.col("a0") > 0.5) == (F.col("y") == 0.0)).cast("int"))).first()[0] > 0.9
    assert decision.first_half(df, F.col("t")).count() == 150


def test_fuzzy_best_query_against_all_pairs(spark):
    """Every part name that the query reverses and edits finds the best entry that all pairs give."""
    from gritstone.plans import registry

    folder = "/root/testdata/sf0.001"
    parts = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_name").collect()
    want = {}
    for p in parts:
        at = p["p_partkey"] % len(p["p_name"])
        noisy = " ".join(reversed((p["p_name"][:at] + p["p_name"][at + 1 :]).split(" ")))
        score, entry = min((-_token_sort_ratio(noisy, q["p_name"]), q["p_name"]) for q in parts)
        if round(-score) >= 90:
            want[noisy] = entry
    got = registry.queries()["fuzzy_best"](spark, folder)
    assert {r["noisy"]: r["p_name"] for r in got.collect()} == want


def test_folder_where_the_session_names_none():
    """Spark refuses to change the setting while it runs, so the folder is remembered instead."""
    from types import SimpleNamespace

    from gritstone.sources.store import fresh_folder

    def no_set(*_):
        raise AssertionError("the setting can't be changed")

    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default, set=no_set), sparkContext=SimpleNamespace(applicationId="app-of-a-test"))
    one, other = fresh_folder(session), fresh_folder(session)
    assert one != other and one.rsplit("/", 1)[0] == other.rsplit("/", 1)[0]
