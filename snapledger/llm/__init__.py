"""Operators on texts and duplicate groups; nothing outside this subpackage imports it."""
