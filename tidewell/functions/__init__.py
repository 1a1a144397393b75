"""Column functions and small frame helpers that the operators share."""
