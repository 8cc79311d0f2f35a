"""Compositions: cleaning jobs, the named results, and the test-table bindings."""
