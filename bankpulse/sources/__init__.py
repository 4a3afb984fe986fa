"""Where the bank tables come from and where results are written."""
