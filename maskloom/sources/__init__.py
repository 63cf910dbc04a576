"""Reading datasets and publishing masked bundles."""
