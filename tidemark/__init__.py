"""A Spark-native toolkit for building, querying and checking metadata indexes."""
