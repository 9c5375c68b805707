"""Named tables and the questions asked of them."""
