"""Column expressions: line rules (text), token and split hashing, Word2Vec variant."""
