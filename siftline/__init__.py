"""siftline: event and entity intelligence as Spark DataFrame plans."""
