from tillroll.sources.tables import read_table, read_csv_table, SCHEMAS  # noqa: F401
from tillroll.sources.ledger import sales_ledger, ledger_sql  # noqa: F401
