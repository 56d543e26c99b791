"""foliate: document structuring and corpus preparation as Spark jobs."""
