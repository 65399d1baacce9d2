"""Web-corpus analytics on Spark: page extraction, link graphs, bounded crawls,
robots decisions, polite schedules and retry accounting as DataFrame jobs."""
