"""Whole jobs: evaluation, ranking, history, audits."""
