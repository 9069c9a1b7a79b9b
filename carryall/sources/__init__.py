"""Reading and writing the job queue, table lists and user tables."""
