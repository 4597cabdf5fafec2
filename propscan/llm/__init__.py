"""Operators that prepare training data at scale. Nothing outside this subpackage imports it."""
