"""Where rows come from and go to: CSV folders, the warehouse, exports, metrics."""
