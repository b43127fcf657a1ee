"""kinfold: customer-profile deduplication written as Spark DataFrame jobs."""
