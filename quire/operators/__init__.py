"""DataFrame operators: tokens, postings, catalogue, ledger, search, crawl frontier."""
