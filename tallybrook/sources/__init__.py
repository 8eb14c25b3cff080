"""Where rows come from: tables, databases, message buses and the test data."""
