"""addrloom: a Spark-native engine that consolidates overlapping mailing lists."""
