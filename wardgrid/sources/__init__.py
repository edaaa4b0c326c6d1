"""Landing files, stored tables, sinks, catalog and the load ledger."""
