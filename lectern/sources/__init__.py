"""Reading and writing of transcript corpora."""
