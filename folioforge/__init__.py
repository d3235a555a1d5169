"""folioforge: Spark-native analytics for bibliographic and legal-text collections."""
