"""DataFrame-to-DataFrame transforms; none of them runs a job."""
