"""Gold tables, marts and the registered queries."""
