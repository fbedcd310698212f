"""Files and catalog tables: reading, writing, and the rules around them."""
