"""Composite plans: stage runner, verification and reports."""
