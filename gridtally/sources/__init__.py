"""Where rows come from and where result tables live."""
