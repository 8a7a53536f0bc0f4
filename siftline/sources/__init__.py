"""Tables out of files and of pages that were fetched before."""
