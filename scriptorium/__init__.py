"""A PySpark-native engine to fold, link, repair, align and search large collections of short texts."""
