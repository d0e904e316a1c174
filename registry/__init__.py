"""One registered query per operator, each with its check in SQL where SQL can express it."""
