"""obsgrid: daily place observations as composable Spark jobs."""
