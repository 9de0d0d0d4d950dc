"""The test and benchmark workload: metering tables derived from the supplied parquet."""
