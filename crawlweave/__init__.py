"""Crawl-frontier and crawl-analytics operators written as Spark DataFrame jobs."""
