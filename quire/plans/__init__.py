"""End-to-end plans: index builds (batch / incremental), crawl extraction, fixtures."""
