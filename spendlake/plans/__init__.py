"""Source-to-facts compositions and reports."""
