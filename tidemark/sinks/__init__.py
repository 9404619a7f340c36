"""Where rows go: versioned file targets, JSON lines, and databases over JDBC."""
