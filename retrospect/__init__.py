"""Point-in-time features, labels, matrices, scores and evaluations of event tables, as Spark plans."""
