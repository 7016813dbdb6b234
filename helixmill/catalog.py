"""All queries of the library by name, and the SQL each is held against."""

from __future__ import annotations

from .plans import bundles, contacts, files, rules, tracks  # noqa: F401  all add to the same tables

QUERIES = contacts.QUERIES
ORACLES = contacts.ORACLES
FLAGSHIP = "pip03_universe"
