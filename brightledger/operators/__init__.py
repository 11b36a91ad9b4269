"""Reusable relational steps: keyed alignment, newest-row picks, shares, sections, checks."""
