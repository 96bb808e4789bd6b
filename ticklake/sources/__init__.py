"""Scans: landed snapshots, tables, and the test tables bound to the ticker domain."""
