"""Star-schema ETL and OLAP queries for banking transactions, as Spark DataFrame jobs."""
