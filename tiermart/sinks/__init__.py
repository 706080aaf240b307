"""Table writes: versions, appends, layouts and the processed-file ledger."""
