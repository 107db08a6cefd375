"""Star-schema loading, checking and reporting on Spark DataFrames."""
