"""Registered queries: each operator over the driver's tables, with the SQL that must give the same rows."""
