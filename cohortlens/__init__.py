"""cohortlens: risk analytics on a yes/no outcome of units that belong to groups, as Spark jobs."""
