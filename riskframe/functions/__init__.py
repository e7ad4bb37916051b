from riskframe.functions.columns import (  # noqa: F401
    ladder, row_sum, row_mean, row_pop_variance, safe_div, qcol, codes_lookup,
)
from riskframe.functions.panel import PeriodPanel, DEFAULT_PANEL, LABEL  # noqa: F401
