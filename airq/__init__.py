"""airq: Spark jobs for indoor and outdoor air-quality sensor series."""
