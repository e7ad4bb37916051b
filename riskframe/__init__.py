"""riskframe: account-level risk analytics as Spark DataFrame operators.

Every public operator takes DataFrames (and column lists / rule objects) and
returns DataFrames.  Work that the reference ran as one Spark job per column is
fused here into one aggregate over all columns; row-wise features are plain
projections that Catalyst collapses into a single whole-stage-codegen span.
"""

from riskframe.functions.panel import PeriodPanel, DEFAULT_PANEL, LABEL

__all__ = ["PeriodPanel", "DEFAULT_PANEL", "LABEL"]
__version__ = "0.1.0"
