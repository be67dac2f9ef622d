"""Operators for preparing training data at scale; nothing outside this subpackage imports it."""
