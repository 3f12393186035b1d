"""Column functions: splitting, joining and rendering lines, parsing labels and scores."""
