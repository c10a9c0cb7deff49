"""Sources: landing CSV, derived fixtures, table scans."""

from ledgerlens.sources.csv import (  # noqa: F401
    INVOICES_GLOB,
    ORGANIZATIONS_GLOB,
    read_raw_csv,
    write_csv,
)
from ledgerlens.sources.fixtures import raw_invoices, raw_organizations, read_test_table  # noqa: F401
from ledgerlens.sources.tables import high_water_mark, read_table, table_exists  # noqa: F401
