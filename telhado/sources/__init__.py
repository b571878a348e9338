"""Where rows come from and go to: dated snapshots and landed reference tables."""
