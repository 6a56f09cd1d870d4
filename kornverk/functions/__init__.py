"""Column functions: text, identifiers, stems and answers in their containers."""
