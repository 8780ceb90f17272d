"""Where rows go: appended tables, snapshots, bucketed state, catalog tables."""
