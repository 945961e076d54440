"""wordloom: text-corpus analytics expressed as PySpark DataFrame jobs."""
