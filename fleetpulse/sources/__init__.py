"""Where rows come from and go to: logs, message streams, CSV extracts, tables."""
