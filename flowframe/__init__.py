"""flowframe: a PySpark-native analytics engine for motion annotation of frame sequences."""
