"""Column -> Column functions. Built-in expressions; only entity decoding needs Python."""
