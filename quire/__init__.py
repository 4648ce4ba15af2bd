"""quire: document-knowledge analytics expressed as Spark DataFrame plans."""
