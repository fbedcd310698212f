"""millrace: the data operations of a big-data job portfolio as DataFrame functions on Spark."""
