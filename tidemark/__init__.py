"""tidemark: financial lakehouse transforms, checks and marts as Spark DataFrame functions."""
