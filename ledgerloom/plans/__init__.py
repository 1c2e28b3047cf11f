"""Composite jobs: scoring, submission, reconciliation, monitoring, reports."""
