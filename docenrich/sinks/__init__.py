"""CSV, one JSON file per document, the ledger table, previews."""
