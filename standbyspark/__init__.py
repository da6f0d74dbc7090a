"""standbyspark: keep a derived standby copy of a set of tables provably consistent with its primary."""
