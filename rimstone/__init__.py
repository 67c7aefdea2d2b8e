"""Bronze-to-silver sports lakehouse jobs written as Spark DataFrame functions."""
