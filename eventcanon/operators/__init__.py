"""DataFrame-to-DataFrame operators. None of them runs a job or brings rows to the driver."""
