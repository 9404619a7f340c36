"""Where rows come from: queries over files and views, and databases over JDBC."""
