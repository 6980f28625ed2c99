"""Reading and writing: extraction, landing files, bronze tables, test sources."""
