"""Scoring (P17, P18): fitted pipeline applied to a table or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.exprs import tier
from tabprep.spec import RISK_CUTS, RISK_DEFAULT, RISK_LABELS


def risk_tier(df: DataFrame, prob_col: str = "p", pred_col: str | None = "prediction",
              cuts=RISK_CUTS, default: str = RISK_DEFAULT) -> DataFrame:
    """Tier on probability x 100 (strict >), and a risk label from the prediction."""
    out = df.withColumn("tier", tier(F.col(prob_col) * 100, cuts, default))
    if pred_col:
        out = out.withColumn("risk_label", F.when(F.col(pred_col) == 1, F.lit(RISK_LABELS[1]))
                             .otherwise(F.lit(RISK_LABELS[0])))
    return out
