"""All queries of the library's own operators, and their SQL."""

from __future__ import annotations

from . import catalogue, features, outcomes, reports, stage, stores

QUERIES = {**features.QUERIES, **outcomes.QUERIES, **reports.QUERIES, **catalogue.QUERIES, **stage.QUERIES, **stores.QUERIES}
SQL = {**features.SQL, **outcomes.SQL, **reports.SQL, **catalogue.SQL, **stage.SQL, **stores.SQL}
