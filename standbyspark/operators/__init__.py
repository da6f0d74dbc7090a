"""DataFrame operators of the replication engine."""
