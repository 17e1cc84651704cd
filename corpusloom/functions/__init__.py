"""Column builders for texts, references and fixed dimensions."""
