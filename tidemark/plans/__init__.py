"""Plans: rule registries, the end-to-end flow, the incremental window and the registered queries."""
