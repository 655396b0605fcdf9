"""Models over the raw tables, and the fixed sequence after a crawl run."""
