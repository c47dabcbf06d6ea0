"""Scorecards: a fitted logistic model as a stage of SQL.

A scorecard is what risk teams deploy of a logistic model: centred and scaled inputs, points
(coefficients) and an intercept, each rounded to a stated number of places, and a score of a
stated number of places. It is saved and loaded like any fitted pipeline, is scored inside
whole-stage code generation, and gives the same score in every engine.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column
from pyspark.sql import functions as F

from cutpoint.operators.model import TrainSummary

#: Places of coefficients, of centres and scales, and of scores.
POINT_PLACES = 4
INPUT_PLACES = 6
SCORE_PLACES = 6


@dataclass(frozen=True)
class Scorecard:
    features: tuple[str, ...]
    center: tuple[float, ...]
    scale: tuple[float, ...]
    points: tuple[float, ...]
    intercept: float
    places: int = SCORE_PLACES

    def sql(self) -> str:
        """The probability of class 1 as a SQL expression over the features."""
        terms = [f"{self.intercept!r}D"]
        for c, m, s, p in zip(self.features, self.center, self.scale, self.points, strict=True):
            terms.append(f"({p!r}D) * ((CAST(`{c}` AS DOUBLE) - ({m!r}D)) / {s!r}D)")
        return f"round(1.0D / (1.0D + exp(-({' + '.join(terms)}))), {self.places})"

    def column(self) -> Column:
        return F.expr(self.sql())

    def model(self) -> PipelineModel:
        """A pipeline that adds ``probability`` (double): what a bundle stores."""
        return PipelineModel([SQLTransformer(statement=f"SELECT *, {self.sql()} AS probability FROM __THIS__")])


def from_model(model: PipelineModel, features: Sequence[str], summary: TrainSummary, point_places: int = POINT_PLACES,
               input_places: int = INPUT_PLACES, places: int = SCORE_PLACES) -> Scorecard:
    """The scorecard of a model fitted with ``fit_logistic(scaled=True, summary=summary)``."""
    lr = model.stages[-1]
    if len(lr.coefficients) != len(features):
        raise ValueError(f"{len(features)} features, but {len(lr.coefficients)} coefficients")
    center, scale = zip(*(summary.scaler[c] for c in features))
    return Scorecard(tuple(features), tuple(round(m, input_places) for m in center),
                     tuple(round(s, input_places) or 1.0 for s in scale),
                     tuple(round(float(c), point_places) for c in lr.coefficients), round(float(lr.intercept), point_places),
                     places)
