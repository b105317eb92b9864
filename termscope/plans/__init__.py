"""End-to-end runs from review files to written results."""
