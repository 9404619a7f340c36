"""DataFrame operators: describe, project, extract, chunk, align, merge, reconcile."""
