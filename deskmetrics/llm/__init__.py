"""Training-data operators over text and vectors. Nothing else in the package imports this folder."""
