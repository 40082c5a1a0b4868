"""Column expressions: unit conversions, sea-water and optics formulas, geometry."""
