"""Queries of decisions and models (inventory 2.13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritstone.operators import decision as d
from gritstone.operators.windows import ratio
from gritstone.plans.registry import Tables, query

_BETS = """(select o_orderkey as match_id, o_custkey, 0.2 + (o_orderkey % 97) / 200.0::double as prob_h, 0.15 + (o_orderkey % 53) / 200.0::double as prob_d, 0.1 + (o_orderkey % 71) / 200.0::double as prob_a,
0.3::double as market_h, 0.28::double as market_d, 0.32::double as market_a, 1.5 + (o_orderkey % 31) / 10.0::double as odds_h, 2.9::double as odds_d, 2.2 + (o_orderkey % 17) / 10.0::double as odds_a from orders)"""


def _bets(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t.orders.select(
        k.alias("match_id"), "o_custkey", (0.2 + (k % 97) / 200.0).alias("prob_h"), (0.15 + (k % 53) / 200.0).alias("prob_d"), (0.1 + (k % 71) / 200.0).alias("prob_a"),
        F.lit(0.3).alias("market_h"), F.lit(0.28).alias("market_d"), F.lit(0.32).alias("market_a"), (1.5 + (k % 31) / 10.0).alias("odds_h"), F.lit(2.9).alias("odds_d"), (2.2 + (k % 17) / 10.0).alias("odds_a"),
    )


@query(
    "M10",
    f"""with l as (select match_id, unnest(['H', 'D', 'A']) as outcome, unnest([0, 1, 2]) as place, unnest([prob_h, prob_d, prob_a]) as prob, unnest([market_h, market_d, market_a]) as market, unnest([odds_h, odds_d, odds_a]) as odds from {_BETS})
    select match_id, outcome, round(prob, 6) as prob, round(odds, 4) as odds, round(prob - market, 6) as edge from l where prob - market > 0.0512 and prob > case when outcome = 'D' then 0.3801 else 0.4001 end and odds > 1
    qualify row_number() over (partition by match_id order by prob - market desc, place) = 1""",
)
def value_bets(t: Tables) -> DataFrame:
    found = d.value_bets(_bets(t), "match_id", edge=0.0512, confidence=0.4001, draw_confidence=0.3801)
    return found.select("match_id", "outcome", *(F.round(c, n).alias(c) for c, n in (("prob", 6), ("odds", 4), ("edge", 6))))


@query(
    "M11 F8",
    f"""select match_id, case when prob_h = g and prob_h - market_h > 0.0512 then 'H' when prob_d = g and prob_d - market_d > 0.0512 then 'D' when prob_a = g and prob_a - market_a > 0.0512 then 'A' else 'none' end as bet
    from (select *, greatest(prob_h, prob_d, prob_a) as g from {_BETS})""",
)
def suggested_bets(t: Tables) -> DataFrame:
    return _bets(t).select("match_id", d.suggested_bet(0.0512).alias("bet"))


@query("M8", f"select match_id, case when prob_d >= 0.3331 then 'D' when prob_h >= prob_a then 'H' else 'A' end as pick from {_BETS}")
def draw_boost(t: Tables) -> DataFrame:
    return _bets(t).select("match_id", d.draw_boost(F.col("prob_h"), F.col("prob_d"), F.col("prob_a"), 0.3331).alias("pick"))


@query("F6 F7 M12 D13")
def bankroll_sim(t: Tables) -> DataFrame:
    """Each customer's bets in order, with stakes from the bankroll left so far."""
    bets = d.value_bets(_bets(t), "match_id", edge=0.05).withColumn("won", F.col("match_id") % 3 == 0)
    out = d.simulate(bets, ["o_custkey"], ["match_id"])
    return out.select("o_custkey", "match_id", "outcome", *(F.round(c, 4).alias(c) for c in ("stake", "profit", "bankroll")))


@query(
    "A25 A32",
    f"""select case when match_id % 3 = 0 then 'won' else 'lost' end as result, match_id % 5 as league, count(*) as n, round(avg(odds_h), 5) as odds, round(sum(case when match_id % 3 = 0 then odds_h - 1 else -1 end) / nullif(count(*), 0), 6) as roi from {_BETS} group by all""",
)
def roi_breakdown(t: Tables) -> DataFrame:
    won = F.col("match_id") % 3 == 0
    profit = F.sum(F.when(won, F.col("odds_h") - 1).otherwise(-1.0))
    by = _bets(t).groupBy(F.when(won, "won").otherwise("lost").alias("result"), (F.col("match_id") % 5).alias("league"))
    return by.agg(F.count("*").alias("n"), F.round(F.avg("odds_h"), 5).alias("odds"), F.round(ratio(profit, F.count("*").cast("double")), 6).alias("roi"))


@query("M2 M3 M4 M5 M6 M7")
def stacked_probabilities(t: Tables) -> DataFrame:
    """Winsorised, imputed and scaled features, tuned models of two sides and one of both, a meta model, and calibrated probabilities.

    Training rows fit all models, validation rows choose parameters, their first half by date calibrates; later rows are scored.
    """
    label = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", label.alias("y"), F.year("l_shipdate").alias("yr"), F.unix_date(F.to_date("l_shipdate")).alias("day"))
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    train, valid, test = rows.where("yr < 1997"), rows.where("yr = 1997"), rows.where("yr > 1997")
    limits = d.winsor_limits(train, cols)
    train, valid, test = (d.winsorised(x, limits) for x in (train, valid, test))
    score = d.stacked_perspectives(train, valid, cols[:2], cols[2:], ["l_discount"], "y")
    names = ["p0", "p1", "p2"]
    held = d.first_half(valid, F.col("day"))
    out = d.calibrated(score(test, names), d.isotonic(score(held, names), names, "y"), names)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *(F.round(n, 4).alias(n) for n in names))
