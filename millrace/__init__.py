"""Lake-file, warehouse and versioned-table operators written for Spark."""
