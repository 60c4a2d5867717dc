"""Plans: the vault model, batch loads, marts and the named query suite."""
