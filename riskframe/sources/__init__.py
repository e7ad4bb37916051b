from riskframe.sources.io import load_table, save_table, sample_rows, read_tables  # noqa: F401
from riskframe.sources.fixtures import accounts, accounts_dirty  # noqa: F401
