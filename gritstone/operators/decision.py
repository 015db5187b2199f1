"""Decisions and their evaluation: value bets, stakes, bankroll, calibration and stacked models."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, RobustScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gritstone.operators.windows import first_per
from gritstone.session import ship

OUTCOMES = ("H", "D", "A")


def value_bets(df: DataFrame, match: str, edge: float = 0.05, confidence: float = 0.4, draw_confidence: float = 0.38, best_only: bool = True) -> DataFrame:
    """Outcomes whose probability exceeds the market's by the edge: a row for each, or each match's best.

    ``df`` has prob_, market_ and odds_ columns of h, d and a. Of equal edges the order is H, D, A.
    """
    rows = [F.struct(F.lit(o).alias("outcome"), F.lit(i).alias("place"), *(F.col(f"{k}_{o.lower()}").cast("double").alias(k) for k in ("prob", "market", "odds"))) for i, o in enumerate(OUTCOMES)]
    keep = [c for c in df.columns if c.split("_")[0] not in ("prob", "market", "odds")]
    long = df.select(*keep, F.explode(F.array(*rows)).alias("b")).select(*keep, "b.*").withColumn("edge", F.col("prob") - F.col("market"))
    good = long.where((F.col("edge") > edge) & (F.col("prob") > F.when(F.col("outcome") == "D", draw_confidence).otherwise(confidence)) & (F.col("odds") > 1))
    if not best_only:
        return good.drop("place")
    return first_per(good, [match], [F.desc("edge"), "place"]).drop("place")


def suggested_bet(edge: float = 0.05) -> Column:
    """The outcome of the highest probability if its edge is enough, else ``none``."""
    top = F.greatest("prob_h", "prob_d", "prob_a")
    out = F.lit("none")
    for o in reversed(OUTCOMES):
        k = o.lower()
        out = F.when((F.col(f"prob_{k}") == top) & (F.col(f"prob_{k}") - F.col(f"market_{k}") > edge), o).otherwise(out)
    return out


def kelly_stake(bankroll: float, p: float, odds: float, draw: bool, cap: float = 0.05, floor: float = 1.0) -> float:
    """Half of Kelly's share (a quarter on draws), capped, at least ``floor``, in cents; 0 without an advantage."""
    gain = odds - 1
    share = (p * gain - (1 - p)) / gain if gain > 0 else 0.0
    if share <= 0:
        return 0.0
    stake = round(max(floor, bankroll * min(cap, share * (0.25 if draw else 0.5))), 2)
    return min(stake, bankroll)


def simulate(bets: DataFrame, keys: Sequence[str], order: Sequence[str], start: float = 1000.0) -> DataFrame:
    """Bets with stake, profit and bankroll: each stake depends on the bankroll left by those before, so a key is one sequence.

    Rows reach Python sorted, partition by partition, and only the running bankroll is held.
    """
    ship(bets.sparkSession)
    keys = list(keys)
    rows = bets.repartition(*keys).sortWithinPartitions(*keys, *order) if keys else bets.coalesce(1).sortWithinPartitions(*order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bankroll, last = start, object()
        for pdf in batches:
            stakes, profits, left = [], [], []
            ids = list(zip(*(pdf[k] for k in keys))) if keys else [()] * len(pdf)
            for own, p, odds, outcome, won in zip(ids, pdf["prob"], pdf["odds"], pdf["outcome"], pdf["won"]):
                if own != last:
                    bankroll, last = start, own
                stake = kelly_stake(bankroll, p, odds, outcome == "D")
                profit = stake * (odds - 1) if won else -stake
                bankroll += profit
                stakes.append(stake)
                profits.append(profit)
                left.append(bankroll)
            yield pdf.assign(stake=stakes, profit=profits, bankroll=left)

    schema = bets.select("*", *(F.lit(0.0).alias(c) for c in ("stake", "profit", "bankroll"))).schema
    return rows.mapInPandas(run, schema)


def draw_boost(p_h: Column, p_d: Column, p_a: Column, threshold: float) -> Column:
    """D from a threshold of its probability on, else the likelier of H and A."""
    return F.when(p_d >= threshold, "D").when(p_h >= p_a, "H").otherwise("A")


def winsor_limits(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> dict[str, tuple[float, float]]:
    """Exact percentiles of each column: two numbers for each reach the driver."""
    row = df.agg(*(F.percentile(c, F.array(F.lit(low), F.lit(high))).alias(c) for c in columns)).first()
    return {c: (row[c][0], row[c][1]) for c in columns if row[c]}


def winsorised(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    clip = lambda c, lo, hi: F.when(F.col(c).isNotNull(), F.greatest(F.least(F.col(c), F.lit(hi)), F.lit(lo)))
    return df.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in limits.items()})


#: regParam and elasticNetParam of the models that a search compares.
GRID = tuple((reg, mix) for reg in (0.001, 0.01, 0.1) for mix in (0.0, 0.5))


def _scaling(columns: Sequence[str]) -> list:
    filled = [f"__{c}" for c in columns]
    return [
        Imputer(strategy="median", inputCols=list(columns), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="__raw"),
        RobustScaler(inputCol="__raw", outputCol="__x", withCentering=True),
    ]


def _logistic(label: str, reg: float = 0.01, mix: float = 0.0) -> LogisticRegression:
    return LogisticRegression(featuresCol="__x", labelCol=label, probabilityCol="__p", family="multinomial", regParam=reg, elasticNetParam=mix, maxIter=50)


def perspective_model(train: DataFrame, columns: Sequence[str], label: str) -> PipelineModel:
    """Median imputation, robust scaling and a multinomial logistic model."""
    return Pipeline(stages=[*_scaling(columns), _logistic(label)]).fit(train)


def tuned_perspective(train: DataFrame, valid: DataFrame, columns: Sequence[str], label: str, grid: Sequence[tuple[float, float]] = GRID) -> PipelineModel:
    """The model of the grid, fitted on the training rows, of the least log loss on the validation rows (the first of equals)."""
    scaling = Pipeline(stages=_scaling(columns)).fit(train)
    rows, held = (scaling.transform(x).select("__x", label) for x in (train, valid))
    loss = MulticlassClassificationEvaluator(metricName="logLoss", labelCol=label, probabilityCol="__p")
    found = [_logistic(label, *one).fit(rows) for one in grid]
    losses = [loss.evaluate(m.transform(held)) for m in found]
    return PipelineModel(stages=[*scaling.stages, found[losses.index(min(losses))]])


def probabilities(model: PipelineModel, df: DataFrame, names: Sequence[str]) -> DataFrame:
    p = vector_to_array("__p")
    out = model.transform(df).withColumns({n: p[i] for i, n in enumerate(names)})
    return out.drop(*(c for c in out.columns if c.startswith("__")), "rawPrediction", "prediction")


def isotonic(df: DataFrame, columns: Sequence[str], label: str):
    """A monotone map of each class's probability, fitted on the rows given."""
    return [IsotonicRegression(featuresCol=c, labelCol="__y", predictionCol=f"{c}__c").fit(df.withColumn("__y", (F.col(label) == i).cast("double"))) for i, c in enumerate(columns)]


def calibrated(df: DataFrame, models, columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Calibrated probabilities, clipped and scaled to sum 1."""
    for m in models:
        df = m.transform(df)
    clipped = {c: F.greatest(F.lit(low), F.least(F.lit(high), F.col(f"{c}__c"))) for c in columns}
    total = sum(list(clipped.values())[1:], clipped[columns[0]])
    return df.withColumns({c: v / total for c, v in clipped.items()}).drop(*(f"{c}__c" for c in columns))


def stacked(train: DataFrame, valid: DataFrame, columns: Sequence[str], meta: Sequence[str], label: str) -> tuple[PipelineModel, PipelineModel]:
    """Base model on the training rows, meta model on its probabilities for the validation rows, market and context columns beside them."""
    base = perspective_model(train, columns, label)
    scored = probabilities(base, valid, ["b0", "b1", "b2"])
    return base, perspective_model(scored, ["b0", "b1", "b2", *meta], label)


def perspectives(train: DataFrame, valid: DataFrame, home: Sequence[str], away: Sequence[str], label: str, grid: Sequence[tuple[float, float]] = GRID) -> list[tuple[PipelineModel, list[str]]]:
    """Tuned models of both sides and one of all columns, each with the names of its probabilities.

    Labels are 0 (home), 1 (draw) and 2 (away). The away side's model has 0 and 2 swapped in its target, and its probabilities
    are named so that h0, a0 and c0 all are those of label 0.
    """
    swap = lambda df: df.withColumn("__swapped", 2.0 - F.col(label))
    return [
        (tuned_perspective(train, valid, home, label, grid), ["h0", "h1", "h2"]),
        (tuned_perspective(swap(train), swap(valid), away, "__swapped", grid), ["a2", "a1", "a0"]),
        (perspective_model(train, [*home, *away], label), ["c0", "c1", "c2"]),
    ]


def stacked_perspectives(train: DataFrame, valid: DataFrame, home: Sequence[str], away: Sequence[str], meta: Sequence[str], label: str):
    """A function from rows and names to the meta model's probabilities, which stand on those of three models and the meta columns.

    The validation rows choose the parameters; the meta model is fitted on the training rows alone.
    """
    models = perspectives(train, valid, home, away, label)

    def base(df: DataFrame) -> DataFrame:
        for model, names in models:
            df = probabilities(model, df, names)
        return df

    last = perspective_model(base(train), [*(n for _, names in models for n in names), *meta], label)
    return lambda df, names: probabilities(last, base(df), names)


def first_half(df: DataFrame, at: Column) -> DataFrame:
    """Rows up to the median of a time or number: one number reaches the driver."""
    middle = df.agg(F.percentile(at, 0.5)).first()[0]
    return df.where(at <= F.lit(middle))
