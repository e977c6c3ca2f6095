"""Gold tables, the serving questions over them, and the layer jobs."""
