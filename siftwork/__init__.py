"""siftwork: a strongly checked, Spark-native query layer."""
