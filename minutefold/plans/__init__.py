"""The layered tables, the questions asked of them, and the run that builds them."""
