"""A Spark-first engine for corpus and question/answer curation."""
