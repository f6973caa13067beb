"""Typed readers, the versioned table store and the test-table stand-ins."""
