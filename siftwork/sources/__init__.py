"""Where rows come from: entities by name, with what a query must know of them."""
