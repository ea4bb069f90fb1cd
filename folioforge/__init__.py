"""folioforge: corpus preparation on PySpark, from scanned text files to retrieval-ready chunks."""
