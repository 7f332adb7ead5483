"""Composite plans: layer transforms, reports, jobs and the test-table bridge."""
