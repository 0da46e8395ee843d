"""textloom: labelled-text analytics as Spark DataFrame operators."""
