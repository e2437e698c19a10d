"""Whole jobs: the daily move plan, training data, model studies, and the registered queries."""
