"""lorespark: verbatim text memory, retrieval and fact queries on PySpark."""
