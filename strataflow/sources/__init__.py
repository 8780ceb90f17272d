"""Where rows come from: landing files, topics, and tables this package wrote."""
