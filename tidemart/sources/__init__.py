"""Reading and writing: files, day tables, relational databases, topics, change logs."""
