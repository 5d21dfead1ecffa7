"""presslens: news-mention analytics written as Spark DataFrame operators."""
