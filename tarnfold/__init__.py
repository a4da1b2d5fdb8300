"""Side-by-side comparison tables, their publication, and their history, on Spark."""
