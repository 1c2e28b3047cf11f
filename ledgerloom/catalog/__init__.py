"""Registered queries: operators bound to the supplied tables, each with the SQL
it has to agree with where SQL can say it."""
from ledgerloom.catalog import (  # noqa: F401
    aggregates, cleaning, files, joining, kyc, lists, recon, reports, scoring, submission, warehouse, windows)
from ledgerloom.catalog.registry import ORACLES, QUERIES  # noqa: F401
