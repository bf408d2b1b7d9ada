"""Feature building, integrity, scoring and reports."""
