"""Feature building, training, evaluation and batch scoring with Spark ML."""
