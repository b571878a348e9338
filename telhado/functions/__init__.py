"""Column expressions: number repair, text, projections, hexagon arithmetic."""
