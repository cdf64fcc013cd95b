"""Fixed tables, end-to-end jobs and the registered queries."""
