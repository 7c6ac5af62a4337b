"""Where rows come from: CSV feeds, stand-in feeds made from the sample tables, shared scratch space."""
