"""End-to-end jobs and read queries."""
