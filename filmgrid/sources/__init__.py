"""Reading landed files, writing results, and the warehouse folder."""
