"""Operators put together into the three rounds of a crawl."""
