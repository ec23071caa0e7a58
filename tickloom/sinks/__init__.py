"""Writers: keyed topics, the upserted feature table, clean copies, exports."""
