"""DataFrame operators: dictionary matching, validation, upsert, ledger, linking."""
