"""Writers: book store, catalogue lines, index and ledger tables, JSON results."""
