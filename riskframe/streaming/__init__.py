"""Streaming use of the row-wise operators.

The source study has no streaming operator (its "real-time" scoring is a
recommendation in prose only), so nothing stream-specific is built here.  The
feature chain (E1-E27) is a pure projection, so it applies unchanged to a
``readStream`` DataFrame; ``score_stream`` is that one-line composition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskframe.functions.panel import DEFAULT_PANEL, PeriodPanel
from riskframe.operators.features import all_features


def score_stream(stream_df: DataFrame, panel: PeriodPanel = DEFAULT_PANEL) -> DataFrame:
    """Apply the feature chain and risk score to a streaming DataFrame."""
    return all_features(stream_df, panel)
