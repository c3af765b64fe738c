"""A Spark-native engine for machine-read documents, the jobs that read them, and training-data pipelines."""
