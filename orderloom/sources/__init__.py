"""Where rows come from: landing files and the sample tables."""
