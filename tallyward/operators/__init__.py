"""DataFrame-to-DataFrame operators. None of them runs a job by itself, except model fitting."""
