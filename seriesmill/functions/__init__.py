"""Column functions: periods, numbers, labels and text cleaning."""
