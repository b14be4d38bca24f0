"""hearken: a Spark-native engine that validates, enriches, unifies and judges customer feedback."""
