"""DataFrame-to-DataFrame operators. None of them does I/O or starts a job, except `row_count`."""
