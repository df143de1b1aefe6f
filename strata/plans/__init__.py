"""Plans: the retail model, silver/gold builders, reports, ledger and runner."""
