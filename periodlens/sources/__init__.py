"""Readers, sinks, versioned tables and the test-table adapter."""
