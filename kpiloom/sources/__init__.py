"""Sources: the driver's tables and the raw CRM tables derived from them."""

from kpiloom.sources.testdata import read_table  # noqa: F401
from kpiloom.sources.crm import raw_tables, FIXTURE_MONTHS  # noqa: F401
