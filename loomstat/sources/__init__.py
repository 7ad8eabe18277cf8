"""Reading tables and files, writing files, generating data from keys."""
