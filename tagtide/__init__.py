"""tagtide: hashtag-post analytics as Spark DataFrame jobs."""
