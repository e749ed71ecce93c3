"""The derived-table catalogue: the shared base, the tables, the feeds and the insights."""
