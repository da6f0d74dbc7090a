"""Multi-step plans over a versioned store: import, rebuild, sync, reconcile, backup and restore."""
