"""The full cleansing run, in the study's order:
missing values (C1-C4) -> duplicates (C7) -> EDUCATION / MARRIAGE recode
(C8, C9) -> negatives (C11, C12) -> outliers (C13, C14) -> status clamp (C16).

The input and the frame after de-duplication (a shuffle of whole rows) are
materialised once each: every later statistic is one fused aggregate over a checkpoint,
not over the input's lineage, and there is nothing left to release.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskframe.functions.panel import DEFAULT_PANEL, PeriodPanel
from riskframe.operators import cleaning as C
from riskframe.session import materialize


def cleanse(df: DataFrame, panel: PeriodPanel = DEFAULT_PANEL, accuracy: int | None = C.DEFAULT_ACCURACY,
            checkpoint_fallback: str | None = None) -> DataFrame:
    out = C.treat_missing(materialize(df, checkpoint_fallback), accuracy=accuracy)
    out = materialize(C.drop_duplicates(out), checkpoint_fallback)
    out = C.recode(out, "EDUCATION", C.EDUCATION_RECODE)
    out = C.recode(out, "MARRIAGE", C.MARRIAGE_RECODE)
    out = C.treat_negatives(out, C.negative_report(out, panel=panel))
    out = C.cap_outliers(out, C.outlier_report(out, panel=panel, accuracy=accuracy))
    return C.clamp_codes(out, panel.available(out.columns, "status"))
