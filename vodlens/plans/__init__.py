"""Report registry and runs: ``catalog`` (queries on the driver's tables),
``daily`` (nightly runs and backfills)."""
