"""matchlake: ball-by-ball match analytics as Spark DataFrame jobs."""
