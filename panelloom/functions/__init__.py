"""Column-level building blocks: text measures and identifier normalisers."""
