"""Repository activity analytics as Spark jobs: raw records in, typed tables and marts out."""
