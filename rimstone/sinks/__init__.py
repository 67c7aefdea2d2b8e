"""Names, paths and writers of datasets and tables."""
