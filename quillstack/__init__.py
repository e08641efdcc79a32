"""quillstack: document-archive analytics on PySpark DataFrames."""
