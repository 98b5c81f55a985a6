"""Where rows come from and go to: tables, snapshots, landed files, exports."""
