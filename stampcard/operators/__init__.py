"""Set operators of the engine: lookups, dedup, decisions, ledger updates."""
