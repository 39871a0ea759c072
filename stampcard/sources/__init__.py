"""Reading check-ins and ledger tables, and the wire formats."""
