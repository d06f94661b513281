"""Sync runs: their specification and their steps."""
