"""The library bound to the sales tables: same operators, other nouns."""
