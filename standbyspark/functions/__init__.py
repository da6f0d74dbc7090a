"""Scalar expressions: type mapping, row encoding, digests and names."""
