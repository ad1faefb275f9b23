"""quillwork: a Spark engine that turns text corpora into training-selection datasets."""
