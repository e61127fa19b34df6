"""Sources, sinks, typed tables and test-data adapters."""
