"""Where rows go: managed tables and delimited text."""
