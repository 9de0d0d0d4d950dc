"""The composite jobs and the tables they keep."""
