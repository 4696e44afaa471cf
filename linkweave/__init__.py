"""Spark-native record linkage: cleaning, blocking, splitting, labelling and training-data operators."""
