"""Spark-native analytics for collections of dated biological sequence records."""
