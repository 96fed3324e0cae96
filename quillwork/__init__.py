"""quillwork: evidence-corpus analytics and text-corpus operators on PySpark DataFrames."""
